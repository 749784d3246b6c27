"""Personal data by weak supervision, with DataFrame functions alone.

Candidates are the matches of a strict pattern for each kind and of a wider pattern for other
spellings. Labelers vote on each: the format (checks such as Luhn's), a gazetteer (top-level domains,
country codes, card prefixes), the context to the left, and the borders of the match. Over all
documents the candidates are counted by kind, votes and shape; expectation-maximisation on the votes
estimates each labeler's reliability. Its posteriors train a logistic span classifier, which
weighs the votes by kind and sees what no labeler does: length, separators, and the characters beside
the match. It is evaluated as a column.

Matches that pass their kind's checks ("base") are always kept; the classifier decides on the others.
Both passes over the texts are maps; only counts are shuffled. Positions are code points.

The work on a text grows in proportion to it, however many matches it has: running sums are made block
by block, and pieces of a text are cut from blocks of it.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in their order; the first four have base spans.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban")

# The patterns of the base kinds. \G and the lookbehinds only spare the search starts
# from which a match could not begin (inside a run that an earlier start has tried, unless a match
# has just ended there); possessive repeats cannot give up what they have taken, as nothing after
# them could match it. So matches are those of the plain patterns, in linear time, without recursion.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Other spellings, one alternative a kind: masked addresses, national numbers, SSN, IBAN.
WIDE = (
    rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{{1,63}}+(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{{1,63}}+)++"
    r"|(?<![0-9A-Za-z+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
    r"|(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
)
#: What a text must hold for a pattern to be worth a search.
_NEEDS = {"email": "contains(t, '@')", "phone": "contains(t, '+')", "ip": "t rlike '[0-9]\\\\.[0-9]'", "card": "t rlike '[0-9][\\\\x20-]?[0-9]'"}

# The gazetteer and the context words (English, German, French, Spanish).
DOMAINS = "com|org|net|edu|gov|io|info|biz|de|fr|es|uk|eu|ch|at|be|it|nl|us|ca|au|mx|ar|co"
COUNTRY_CODES = "1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
CARD_PREFIXES = "4|5[1-5]|2[2-7]|3[47]|6011|65|35"
RESERVED = "0|10|127|169\\.254|192\\.168|22[4-9]|2[34][0-9]|25[0-5]"
NEAR_YES = {
    "email": "mail|contact|write|kontakt|courriel|correo|escrib|schreib", "ip": "ip|host|server|address|adresse|login|client|serveur|servidor",
    "card": "card|visa|master|amex|karte|carte|tarjeta|pay|zahl", "phone": "phone|call|tel|mobile|fax|ruf|handy|appel|llam|contact",
    "ssn": "ssn|social|security", "iban": "iban|bank|account|konto|compte|cuenta",
}
NEAR_NO = "version|release|section|figure|isbn|issn|order no|invoice|serial|sku|commit|hash|token|checksum|kapitel|abschnitt|pedido|commande"

VOTES = ("v_format", "v_gazetteer", "v_context", "v_border")
LENGTHS = (8, 12, 16, 20, 32)


#: Elements that a running value is made for at once, and code points of a text that pieces are cut from.
BLOCK, TEXT_BLOCK = 256, 4096


def _let(value: str, name: str, use: str) -> str:
    """SQL for ``use`` with the value, computed once, as ``name``."""
    return f"element_at(transform(array({value}), {name} -> {use}), 1)"


def _running(array: str, join: str) -> str:
    """SQL for what ``join`` (of a and b) makes of all elements of an array of int before each, from 0 on."""
    last = "element_at(a, -1)"
    step = join.format(a=last, b="b")
    own = f"transform(sequence(0, greatest(size(w) - 1, 0) div {BLOCK}), c -> aggregate(slice(w, c * {BLOCK} + 1, {BLOCK}), array(0), (a, b) -> concat(a, array({step}))))"
    offsets = f"aggregate(own, array(0), (a, l) -> concat(a, array({join.format(a=last, b='element_at(l, -1)')})))"
    whole = f"flatten(transform(own, (l, c) -> transform(slice(l, 1, size(l) - 1), y -> {join.format(a='offsets[c]', b='y')})))"
    return _let(array, "w", _let(own, "own", _let(offsets, "offsets", whole)))


def _matches(pattern: str) -> str:
    """SQL for the matches of a pattern in ``t``, which has one: start, end, text, left and right of each.

    A split at the pattern gives what lies between the matches, so lengths add up to positions.
    """
    p = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    ats = _running("transform(p.m, (m, i) -> char_length(p.g[i]) + char_length(m))", "{a} + {b}")
    rows = """transform(p.m, (m, i) -> named_struct('s', ats[i] + char_length(p.g[i]), 'e', ats[i] + char_length(p.g[i]) + char_length(m),
        'm', m, 'l', right(p.g[i], 40), 'r', left(p.g[i + 1], 1)))"""
    return _let(f"named_struct('m', regexp_extract_all(t, {p}, 0), 'g', split(t, {p}, -1))", "p", _let(ats, "ats", rows))


_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
#: Whether a match of the kind's pattern passes the kind's checks.
_VALID = {
    "email": "true",
    "ip": "forall(split(x.m, '\\\\.'), q -> char_length(ltrim('0', q)) <= 3 and coalesce(try_cast(ltrim('0', q) as int), 0) <= 255)",
    "card": f"(char_length({_DIGITS}) between 14 and 19 and luhn_check({_DIGITS}))",
    "phone": f"char_length({_DIGITS}) between 10 and 15",
}
#: Whether a match that fails the checks is near enough to be a candidate.
_PLAUSIBLE = {
    "email": "true",
    "ip": "char_length(x.m) <= 23",
    "card": f"char_length({_DIGITS}) between 13 and 19",
    "phone": f"char_length({_DIGITS}) between 7 and 15",
}
_GAZETTEER = {
    "email": f"if(x.m rlike '(?i)(?:[.]|dot[\\\\])]\\\\x20?)(?:{DOMAINS})$', 1, -1)",
    "ip": f"if(x.m rlike '^(?:{RESERVED})\\\\.', -1, 1)".replace("169\\.254", "169\\\\.254").replace("192\\.168", "192\\\\.168"),
    "card": f"if({_DIGITS} rlike '^(?:{CARD_PREFIXES})', 1, -1)",
    "phone": f"if(x.m rlike '^\\\\+(?:{COUNTRY_CODES})' or x.m rlike '^\\\\(?[2-9]', 1, -1)",
    "ssn": "if(x.m rlike '^(?:000|666|9)', -1, 1)",
    "iban": "if(x.m rlike '^(?:AT|BE|CH|DE|ES|FR|GB|IT|LU|NL|PL|PT)', 1, -1)",
}


#: Features of a candidate that are no votes, with how many values each has.
SHAPES = {"length": len(LENGTHS) + 1, "separators": 4, "left": 5, "right": 5}


def _beside(character: str, marks: str) -> str:
    """SQL for the class of a character beside a match: none, white space, of certain marks, letter or digit, other."""
    return f"case when {character} = '' then 0 when {character} rlike '\\\\s' then 1 when {character} rlike '[{marks}]' then 2 when {character} rlike '[\\\\p{{L}}\\\\p{{N}}]' then 3 else 4 end"


def _candidate(kind: str, base: str, valid: str) -> str:
    near = f"case when lower(x.l) rlike '(?:{NEAR_NO})[^a-z]*[a-z]{{0,12}}[^a-z]*$' then -1 when lower(x.l) rlike '(?:{NEAR_YES[kind]})' then 1 else 0 end"
    border = "if(x.l rlike '[A-Za-z0-9_=\"\\'/-]$' or x.r rlike '[A-Za-z0-9_\"\\'/-]', -1, 1)"
    length = " + ".join(f"if(x.e - x.s > {n}, 1, 0)" for n in LENGTHS)
    separators = "least(3, char_length(x.m) - char_length(regexp_replace(x.m, '[\\\\s().-]', '')))"
    return f"""named_struct('start', x.s, 'kind', {KINDS.index(kind)}, 'end', x.e, 'base', {base},
        'v_format', if({valid}, 1, -1), 'v_gazetteer', {_GAZETTEER[kind]}, 'v_context', {near}, 'v_border', {border}, 'length', {length},
        'separators', {separators}, 'left', {_beside("right(x.l, 1)", ":=(<")}, 'right', {_beside("x.r", ".,;:)>")})"""


_EMPTY = f"cast(array() as array<struct<start:int,kind:int,end:int,base:boolean,{','.join(f'{v}:int' for v in (*VOTES, *SHAPES))}>>)"


def candidates(text: str = "text") -> Column:
    """All candidate spans of the texts in a column (null: empty), base matches and others, as an array of structs."""
    arrays = []
    for kind, pattern in PATTERNS.items():
        p = "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
        near = f"filter({_matches(pattern)}, x -> {_VALID[kind]} or {_PLAUSIBLE[kind]})"
        some = f"transform({near}, x -> {_candidate(kind, _VALID[kind], _VALID[kind])})"
        arrays.append(f"if({_NEEDS[kind]} and t rlike {p}, {some}, {_EMPTY})")
    p = "'" + WIDE.replace("\\", "\\\\").replace("'", "\\'") + "'"
    by_kind = f"""case when x.m rlike '[A-Za-z]{{2}}[0-9]{{2}}' and not x.m rlike '[\\\\[(]' then {_candidate("iban", "false", "true")}
        when x.m rlike '[A-Za-z]' then {_candidate("email", "false", "true")}
        when x.m rlike '^[0-9]{{3}}-[0-9]{{2}}-' then {_candidate("ssn", "false", "true")}
        else {_candidate("phone", "false", f"char_length({_DIGITS}) = 10")} end"""
    arrays.append(f"if(t rlike {p}, transform({_matches(WIDE)}, x -> {by_kind}), {_EMPTY})")
    # The text is bound to a lambda variable, so that it is one value to all the patterns.
    return F.expr(f"element_at(transform(array(coalesce({text}, '')), t -> concat({', '.join(arrays)})), 1)")


#: Features of the classifier, by name, with how many values each has; a vote has its value and 1.
FEATURES = dict.fromkeys(VOTES, 3) | SHAPES


class Model:
    """Log-odds weights of the span classifier, by kind and by kind and value of each feature; reliabilities of the labelers."""

    def __init__(self, kind: list[float], features: dict[str, list[list[float]]], reliability: dict[str, float]):
        self.kind, self.features, self.reliability = kind, features, reliability

    def accepts(self, x: Column) -> Column:
        """Whether a candidate that is not base is personal data."""
        pick = lambda weights, at: F.element_at(F.array(*map(F.lit, weights)), at + 1)
        total = pick(self.kind, x["kind"])
        for name, weights in self.features.items():
            value = x[name] + 1 if name in VOTES else x[name]
            total = total + pick([w for row in weights for w in row], x["kind"] * len(weights[0]) + value)
        return total >= 0


def fit(docs: DataFrame, rounds: int = 30) -> Model:
    """Counts the candidates of all of ``docs`` by votes and shape, runs EM on the counts, and trains the classifier.

    The counts that come to the driver are one for each kind, votes and shape: a few thousand, whatever
    the corpus, and no more than there are such values. No candidates: labelers are as right as they are
    believed to be before, and the classifier accepts by the format and the other votes.
    """
    x = docs.select(F.explode(candidates()).alias("x")).select("x.*")
    table = x.groupBy("kind", *VOTES, *SHAPES).agg(F.count("*").alias("n")).collect()
    return train([tuple(r) for r in table], rounds)


def train(table: list[tuple[int, ...]], rounds: int = 30) -> Model:
    """The model of rows of kind, votes, shape and the count of such candidates."""
    columns = dict(zip(("kind", *VOTES, *SHAPES, "n"), np.array(sorted(table), np.int64).reshape(len(table), len(FEATURES) + 2).T, strict=True))
    kind, n = columns["kind"], columns["n"].astype(float)
    votes = np.stack([columns[v] for v in VOTES], axis=1).astype(float)
    believed = np.array([0.9 if v == "v_format" else 0.7 for v in VOTES])  # chance that a vote, if cast, is right
    right, prior = believed, np.full(len(KINDS), 0.5)

    def posterior() -> np.ndarray:
        return 1 / (1 + np.exp(-(np.log(prior / (1 - prior))[kind] + votes @ np.log(right / (1 - right)))))

    for _ in range(rounds):  # one-coin model: E step, then M step with two rows of belief in the start
        p = posterior()
        hit = ((votes > 0) * (n * p)[:, None] + (votes < 0) * (n * (1 - p))[:, None]).sum(axis=0) + 2 * believed
        cast = ((votes != 0) * n[:, None]).sum(axis=0) + 2
        # A labeler is believed to be better than chance, which settles which class is which.
        right = np.clip(hit / cast, 0.55, 0.99)
        prior = np.clip((np.bincount(kind, n * p, len(KINDS)) + 1) / (np.bincount(kind, n, len(KINDS)) + 2), 0.02, 0.98)
    p = posterior()

    # Logistic regression on the posteriors. Weights shrink to those of the label model for votes, and to none for
    # shapes, so that rare values follow the labelers; counts are damped, so that no one frequent shape is all.
    start = {name: np.tile((np.arange(size) - 1) * np.log(right / (1 - right))[VOTES.index(name)], (len(KINDS), 1)) if name in VOTES else np.zeros((len(KINDS), size)) for name, size in FEATURES.items()}
    w_kind, w = np.log(prior / (1 - prior)), {name: x.copy() for name, x in start.items()}
    at = {name: columns[name] + (name in VOTES) for name in FEATURES}
    weight = np.sqrt(n)
    scale = np.maximum(np.bincount(kind, weight, len(KINDS)), 1.0)
    for _ in range(300):
        z = w_kind[kind] + sum(w[name][kind, at[name]] for name in FEATURES)
        step = weight / scale[kind] * (p - 1 / (1 + np.exp(-np.clip(z, -30, 30))))
        w_kind = w_kind + 0.5 * np.bincount(kind, step, len(KINDS))
        for name, size in FEATURES.items():
            gradient = np.bincount(kind * size + at[name], step, len(KINDS) * size).reshape(len(KINDS), size)
            w[name] = w[name] + 0.5 * gradient - 0.001 * (w[name] - start[name])
    return Model(w_kind.tolist(), {name: x.tolist() for name, x in w.items()}, dict(zip(VOTES, right.tolist(), strict=True)))


def spans(model: Model) -> Column:
    """The spans of ``text``, by start and then kind: array of (start, kind, end, base).

    Base spans all stay, also where spans of two kinds overlap. Other spans are kept if the
    classifier accepts them and no base span overlaps them.
    """

    def choose(found: Column) -> Column:
        base = F.array_sort(F.filter(found, lambda x: x["base"]))
        more = F.filter(found, lambda x: ~x["base"])
        # Blocks of base spans, by start, with where they begin and end at most: few of them are near a span.
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(base) - 1) / BLOCK).cast("int")), lambda c: F.slice(base, c * BLOCK + 1, BLOCK))
        parts = F.when(F.size(base) > 0, F.transform(parts, lambda p: F.struct(p[0]["start"].alias("start"), F.array_max(F.transform(p, lambda b: b["end"])).alias("end"), p.alias("spans"))))
        parts = F.coalesce(parts, F.slice(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), base.alias("spans"))), 1, 0))

        def decide(blocks: Column) -> Column:
            def near(x: Column) -> Column:
                return F.exists(blocks, lambda p: (p["start"] < x["end"]) & (x["start"] < p["end"]) & F.exists(p["spans"], lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))

            kept = F.filter(more, lambda x: model.accepts(x) & ~near(x))
            return F.array_sort(F.transform(F.concat(base, kept), lambda x: F.struct(x["start"], x["kind"], x["end"], x["base"])))

        return F.element_at(F.transform(F.array(parts), decide), 1)

    return F.element_at(F.transform(F.array(candidates()), choose), 1)


def find(docs: DataFrame, model: Model, name: str = "pii") -> DataFrame:
    """The columns of ``docs`` (with ``text``) and an array ``name`` of the spans in each whole text.

    Null and empty texts have none. Repeated rows stay; an empty table gives an empty result; a
    column that is called ``name`` already is replaced.
    """
    return docs.withColumn(name, spans(model))


def joined(found: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; overlapping spans become one. Null texts stay null."""
    tags = ", ".join(f"'[{k.upper()}]'" for k in KINDS)

    def piece(a: str, b: str) -> str:
        """The code points from a to b: the end of a block, whole blocks, and the beginning of a block."""
        one = f"substring(blocks[{a} div {TEXT_BLOCK}], {a} % {TEXT_BLOCK} + 1, {b} - {a})"
        first, last = f"substring(blocks[{a} div {TEXT_BLOCK}], {a} % {TEXT_BLOCK} + 1)", f"left(coalesce(get(blocks, {b} div {TEXT_BLOCK}), ''), {b} % {TEXT_BLOCK})"
        middle = f"array_join(slice(blocks, {a} div {TEXT_BLOCK} + 2, {b} div {TEXT_BLOCK} - {a} div {TEXT_BLOCK} - 1), '')"
        return f"if({a} >= {b}, '', if({a} div {TEXT_BLOCK} = {b} div {TEXT_BLOCK}, {one}, concat({first}, {middle}, {last})))"

    # "ends" is where the spans before each end at most: what lies before that is in one of them.
    ends = _running("transform(pii, x -> x.end)", "greatest({a}, {b})")
    out = f"transform(pii, (x, i) -> if(x.start >= ends[i], concat({piece('ends[i]', 'x.start')}, element_at(array({tags}), x.kind + 1)), ''))"
    tail = piece("array_max(transform(pii, x -> x.end))", "n")
    whole = _let(f"regexp_extract_all(text, '(?s).{{1,{TEXT_BLOCK}}}', 0)", "blocks", _let("char_length(text)", "n", _let(ends, "ends", f"concat(array_join({out}, ''), {tail})")))
    name = next(c for c in map("pii{}".format, itertools.count()) if c not in docs.columns)
    whole = F.expr(_let(f"`{name}`", "pii", f"if(size(pii) = 0, text, {whole})"))
    return docs.withColumn(name, F.when(F.col("text").isNotNull(), spans(model))).withColumn("text", F.when(F.col("text").isNotNull(), whole)).drop(name)
