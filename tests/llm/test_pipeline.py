import hashlib

import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq
from test_maps import brute_hits, toxic_rows
from test_near_dedup import brute
from test_pii import base

import public_tokenizers
import tiktoken
from graphloom.llm import byte_bpe, pii

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def write(folder):
    rows = toxic_rows(400)
    texts = {i: t for i, t, _ in rows}
    for i in range(0, 60, 3):
        texts[1000 + i] = texts[i]
    texts |= {2001: "mail me at a.b@c.de today please", 2002: None, 2003: "", 2004: " ".join(texts[3].split()[:12]), 2005: "call +1 555 555 12 34 now"}
    items = {1: " ".join(texts[5].split()[:15]), 2: " ".join(texts[8].split()[5:20])}
    ids = list(texts)
    pq.write_table(pa.table({"doc_id": ids, "text": pa.array([texts[i] for i in ids], pa.string()), "lang": ["en"] * len(ids), "source": ["s"] * len(ids), "n_chars": [len(texts[i] or "") for i in ids]}), f"{folder}/documents.parquet")
    pq.write_table(pa.table({"doc_id": [i for i, _, _ in rows], "quality": [1] * len(rows), "toxic": pa.array([t for *_, t in rows], pa.int32())}), f"{folder}/labels.parquet")
    pq.write_table(pa.table({"item_id": list(items), "text": list(items.values())}), f"{folder}/benchmark.parquet")
    return texts, items, {i for i, _, t in rows if t}


def test_stages_against_brute_force(spark, tmp_path):
    texts, items, toxic = write(tmp_path)
    folder = f"file://{tmp_path}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "pii", "byte_bpe"]

    clean = stages["toxicity"](spark, docs, folder)
    assert clean.columns == COLUMNS
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    copies = {i for i in texts if i >= 1000 and texts[i] and any(texts[i] == texts[t] for t in toxic)}
    assert len(set(left) & (toxic | copies)) <= 0.1 * len(toxic | copies)
    assert len(set(texts) - set(left) - toxic - copies) <= 0.03 * len(texts)

    unique = stages["near_dedup"](spark, clean, folder)
    assert unique.columns == COLUMNS
    classes = brute([(i, t) for i, t in left.items()], 5)
    kept = {r["doc_id"]: r["text"] for r in unique.collect()}
    assert set(kept) == {i for i, x in classes.items() if x[2]}

    pure = stages["decontamination"](spark, unique, folder)
    hits = dict(zip(kept, brute_hits(list(kept.values()), list(items.items())), strict=True))
    pure_texts = {r["doc_id"]: r["text"] for r in pure.collect()}
    assert pure.columns == COLUMNS and set(pure_texts) == {i for i, x in hits.items() if not x[1]}

    redacted = stages["pii"](spark, pure, folder)
    assert redacted.columns == COLUMNS
    for r in redacted.collect():
        want, at = "", 0
        for start, kind, end in base(pure_texts[r["doc_id"]]):
            want += pure_texts[r["doc_id"]][at:start] + f"[{pii.KINDS[kind].upper()}]"
            at = end
        assert r["text"] == (None if pure_texts[r["doc_id"]] is None else want + pure_texts[r["doc_id"]][at:])
        assert r["text"] is None or r["n_chars"] == len(r["text"])

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    said = {r["doc_id"]: r["text"] or "" for r in redacted.collect()}
    for r in stages["byte_bpe"](spark, redacted, folder).collect():
        assert r["n_tokens"] == len(own.encode_ordinary(said[r["doc_id"]]))
        assert r["decoded_sha256"] == hashlib.sha256(said[r["doc_id"]].encode()).hexdigest()
    assert corpus_pipeline.run(spark, folder).count() == len(said)
