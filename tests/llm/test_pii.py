import hashlib
import random
import time
import re

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from graphloom.llm import pii, queries


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_against_plain_patterns(spark):
    r = random.Random(2)
    pieces = ["a.b@c.d", "x@y.co_z@q.de", "@", "é", "🎉", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "+1 (555) 555-1234", "+49 30 1234567", "+1", " ", "\n",
              "tel: ", "12", "007.0001.000255.1", "foo", "-", ".", "+", "a@b", "--@x.y.z", "99999999999999999999999"]
    texts = ["".join(r.choices(pieces, k=r.randint(0, 25))) for _ in range(400)] + ["", None, "1 " * 20000, "a" * 30000 + "@b.c", "9" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    model = pii.fit(df)
    for row in pii.find(df, model).collect():
        assert sorted((s["start"], s["kind"], s["end"]) for s in row["pii"] if s["base"]) == base(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_query_against_plain_patterns(spark, tmp_path):
    """The columns of op4_pii by its contract, where the kinds of a text differ in number and order."""
    r = random.Random(7)
    pieces = ["a.b@c.d ", "1.2.3.4 ", "4111 1111 1111 1111x", "+1 (555) 555-1234x", "555-123-4567 ", "256.1.1.1 ", "4111111111111112x", "é🎉 ", "word "]
    texts = ["".join(r.choices(pieces, k=r.randint(0, 12))) for _ in range(300)] + ["", None, "a@b.cd", "a@b.cd e@f.gh", "+49 30 1234567", "1.2.3.4@b.c", "00000000000000.1.1.1"]
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": texts}), f"{tmp_path}/documents.parquet")
    rows = queries.op4_pii(spark, f"file://{tmp_path}").collect()
    assert sorted(x["doc_id"] for x in rows) == list(range(len(texts)))
    for row in rows:
        found = base(texts[row["doc_id"]])
        assert [row[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(kind == i for _, kind, _ in found) for i in range(4)], texts[row["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found).encode()).hexdigest()


def test_other_spellings_and_redaction(spark):
    rows = [(1, "call 555-123-4567 or mail jo [at] example [dot] com now"), (2, "mail a@b.com"), (3, "plain"), (4, None), (5, "my ssn 123-45-6789, phone (212) 555-0100")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'clash' AS pii")
    model = pii.train([(3, 1, 1, 1, 1, 2, 2, 1, 1, 50), (3, -1, -1, 0, -1, 2, 2, 1, 1, 50), (2, -1, -1, 0, -1, 2, 2, 1, 1, 50), (0, 1, 1, 0, 1, 2, 1, 1, 1, 80)])
    got = {r["doc_id"]: r for r in pii.find(df, model).collect()}
    kinds = lambda i: [pii.KINDS[s["kind"]] for s in got[i]["pii"]]
    assert kinds(1) == ["phone", "email"] and kinds(2) == ["email"] and kinds(3) == [] and kinds(4) == []
    assert kinds(5) == ["ssn", "phone"]
    text = {r["doc_id"]: r["text"] for r in pii.redact(df, model).collect()}
    assert text == {1: "call [PHONE] or mail [EMAIL] now", 2: "mail [EMAIL]", 3: "plain", 4: None, 5: "my ssn [SSN], phone [PHONE]"}


def test_overlapping_spans_become_one(spark):
    df = spark.createDataFrame([(1, "at x@1.2.3.4 now")], "doc_id bigint, text string")
    assert pii.redact(df, pii.train([])).first()["text"] == "at [EMAIL] now"


def test_em_finds_the_better_labelers():
    table = []
    for truth, n in ((1, 600), (-1, 400)):
        for f in (1, -1):
            for c in (1, 0, -1):
                share = (0.95 if f == truth else 0.05) * (0.1 if c == 0 else 0.9 * (0.8 if c == truth else 0.2))
                table.append((3, f, truth, c, 1, 2, 2, 1, 1, int(n * share)))
    model = pii.train(table)
    assert model.reliability["v_format"] > model.reliability["v_context"] > 0.6


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert pii.find(df, pii.fit(df)).count() == 0


def overlaps(a, b):
    return a[0] < b[2] and b[0] < a[2]


def test_added_spans_against_the_model(spark):
    """Added spans are the candidates that the classifier accepts and no base span overlaps, whatever the number of spans."""
    r = random.Random(5)
    pieces = ["a.b@c.de ", "555-123-4567 ", "(212) 555-0100, ", "123-45-6789 ", "jo [at] ex [dot] org ", "DE89 3704 0044 0532 0130 00 ", "4111 1111 1111 1112 ", "call: ", "version 1.2.3.4 ", "999.1.1.1 ", "+12 345 ", "é🎉 ", "x"]
    texts = ["".join(r.choices(pieces, k=k)) for k in [*[8] * 150, 700, 900]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    model = pii.fit(df)
    all_ = df.select("doc_id", pii.candidates().alias("c"), pii.spans(model).alias("s")).collect()
    added = 0
    for row in all_:
        base = [(x["start"], x["kind"], x["end"]) for x in row["c"] if x["base"]]
        want = list(base)
        for x in row["c"]:
            z = model.kind[x["kind"]] + sum(w[x["kind"]][x[name] + (name in pii.VOTES)] for name, w in model.features.items())
            span = (x["start"], x["kind"], x["end"])
            if not x["base"] and z >= 0 and not any(overlaps(span, b) for b in base):
                want.append(span)
                added += 1
        assert [(s["start"], s["kind"], s["end"]) for s in row["s"]] == sorted(want)
        own = texts[row["doc_id"]]
        assert all(len(own[s["start"] : s["end"]].strip()) == s["end"] - s["start"] for s in row["s"])
    assert added > 300


def test_redaction_against_python(spark):
    r = random.Random(6)
    texts = ["".join(r.choices(["a.b@c.de", "x@1.2.3.4", " ", "é🎉", "word ", "+1 555 555 1234", "\n", "y" * 500], k=k)) for k in [*[12] * 100, 600]] + ["y" * 4095 + " a@b.cd", " " * 4096 + "a@b.cd", "a@b.cd"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    model = pii.fit(df)
    found = {x["doc_id"]: x["pii"] for x in pii.find(df, model).collect()}
    for row in pii.redact(df, model).collect():
        own, out, at = texts[row["doc_id"]], "", 0
        for s in found[row["doc_id"]]:
            if s["start"] >= at:
                out += own[at : s["start"]] + f"[{pii.KINDS[s['kind']].upper()}]"
            at = max(at, s["end"])
        assert row["text"] == out + own[at:]


def test_very_many_matches_take_seconds(spark):
    text = "".join(f"a{i}@b.cd 555-123-{i % 10000:04} " for i in range(100_000))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    model = pii.train([])
    begun = time.monotonic()
    assert pii.find(df, model).select(F.size(F.filter("pii", lambda x: x["base"]))).first()[0] == 100_000
    assert pii.redact(df, model).first()["text"].count("[EMAIL]") == 100_000
    assert time.monotonic() - begun < 120
