"""Personal data by weak supervision, in DataFrame functions only.

Four kinds of base spans are found by exact rules and always kept. Looser patterns give candidates for further spans
(written-out mail addresses, national phone numbers, named secrets). For every base span and candidate four labelers
vote: a pattern labeler, a gazetteer, a context labeler on the words before, and a shape labeler. Expectation-maximisation
over the counts of vote patterns estimates how reliable each labeler is; the resulting soft labels train a logistic
span classifier on the spans' own features, again from counts by feature pattern. Candidates that it accepts are added.

Texts are read once. Counts cover all documents; what reaches the driver is one row per kind and vote or feature
pattern, of which there are at most a few thousand whatever the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.session import settled

KINDS = ("email", "ip", "card", "phone", "secret")

# The base patterns, written so that the engine neither recurses nor scans a run of characters from each of its places:
# possessive quantifiers where nothing after them could use a shorter match, and starts only at the beginning of a run
# or at the end of the match before.
_LOCAL = "[A-Za-z0-9._%+-]"
_RUN = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++"
BASE = {
    "email": rf"{_RUN}@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"{_RUN}\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]++(?:\x20?(?:\[dot\]|\(dot\)|\.)\x20?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
    "secret": r"(?:token|secret|password|passwd|api_key|apikey)\x20{0,3}[=:]\x20{0,3}[\"']?[A-Za-z0-9_+/-]{16,}+[\"']?",
}
# Fixed values of the gazetteer and context labelers.
TOP_LEVEL = "com net org edu gov info io de fr es uk eu us".split()
PRIVATE_NETS = ("0.", "10.", "127.", "192.168.", "255.")
CONTEXT = {
    "email": "mail contact write an to from".split(),
    "ip": "ip host server address client".split(),
    "card": "card visa credit account payment".split(),
    "phone": "phone call tel mobile fax".split(),
    "secret": "key token secret password login".split(),
}

#: Characters of text before a span that the context labeler sees.
BEFORE = 24
ROUNDS = 30
SPAN = "array<struct<start:bigint,end:bigint,value:string,before:string>>"


def spans(text: str, pattern: str) -> tuple[Column, Column]:
    """The matches, and the pieces of text around them."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def placed(found: Column, pieces: Column) -> Column:
    """Spans in code points, with value and the end of the text before, from the matches and the pieces around them."""
    none = F.expr(f"cast(array() as {SPAN})")
    zipped = F.zip_with(pieces, found, lambda piece, value: F.struct(piece.alias("piece"), value.alias("value")))

    def add(state: Column, item: Column) -> Column:
        start = state["at"] + F.length(item["piece"])
        end = start + F.coalesce(F.length(item["value"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), item["value"].alias("value"), F.right(item["piece"], F.lit(BEFORE)).alias("before"))
        return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    folded = F.aggregate(zipped, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans")), add, lambda state: state["spans"])
    return F.when(F.size(found) > 0, F.filter(folded, lambda s: s["value"].isNotNull())).otherwise(none).cast(SPAN)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the checksum."""

    def worth(i: Column) -> Column:
        digit = F.substring(number, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return F.when((F.length(number) - i) % 2 == 1, twice).otherwise(digit)

    sums = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda total, i: total + worth(i))
    return sums % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The rules that a base match must pass."""
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+(?=.)", "")
        return F.forall(F.split(value, "\\."), lambda x: (F.length(part(x)) <= 3) & (part(x).cast("int") <= 255))
    if kind == "card":
        number = digits(value)
        return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def _passes(kind: str):
    return lambda s: valid(kind, s["value"])


def _item(kind: str, base: bool):
    return lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), s["value"].alias("value"), s["before"].alias("before"))


def _cut(kind: str):
    return lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(f"<{kind.upper()}>").alias("mask"))


def searched(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``carry`` columns (as ``_c0``...), base spans by kind, and loose candidates that overlap no base span."""
    own = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(carry, own, strict=True)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    patterns = {f"base_{k}": p for k, p in BASE.items()} | {f"loose_{k}": p for k, p in LOOSE.items()}
    rows = rows.select(*own, "t", *[spans("t", p)[0].alias(name) for name, p in patterns.items()])
    rows = rows.select(*own, *[placed(F.col(name), spans("t", p)[1]).alias(name) for name, p in patterns.items()])
    passed = [F.filter(f"base_{k}", _passes(k)).alias(f"base_{k}") for k in BASE]
    rows = rows.select(*own, *passed, *[f"loose_{k}" for k in LOOSE])
    every = F.concat(*[F.transform(f"base_{k}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in BASE])
    rows = rows.select("*", every.alias("taken"))
    free = lambda s: ~F.exists("taken", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return rows.select(*own, *[f"base_{k}" for k in BASE], *[F.filter(f"loose_{k}", free).alias(f"loose_{k}") for k in LOOSE])


def votes(kind: Column, value: Column, before: Column, base: Column) -> dict[str, Column]:
    """Per labeler 1 (personal), -1 (not) or 0 (no opinion)."""
    by_kind = lambda cases: F.coalesce(*[F.when(kind == k, c) for k, c in cases.items()], F.lit(0))
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    net = F.lit(False)
    for head in PRIVATE_NETS:
        net = net | value.startswith(head)
    number, none = F.length(digits(value)), F.lit(False)
    words = F.split(F.lower(before), "[^a-z]+")
    return {
        "pattern": F.when(base, 1).otherwise(0),
        "gazetteer": by_kind(
            {
                "email": vote(F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1)).isin(TOP_LEVEL), none),
                "ip": vote(~net, net),
                "card": vote(value.substr(1, 1).isin("3", "4", "5", "6"), value.substr(1, 1) == "0"),
                "phone": vote(none, F.regexp_extract(value, "([0-9]{3})", 1) == "000"),
                "secret": vote(F.lower(value).rlike("[0-9a-f]{32}"), none),
            }
        ),
        "context": by_kind({k: vote(F.arrays_overlap(words, F.array(*map(F.lit, w))), none) for k, w in CONTEXT.items()}),
        "shape": by_kind(
            {
                "email": vote(F.length(value).between(6, 64), F.length(value) > 128),
                "ip": vote(F.length(value) >= 8, none),
                "card": vote(number.isin(15, 16), none),
                "phone": vote(number.between(10, 12), number < 9),
                "secret": vote(value.rlike("[0-9]") & value.rlike("[A-Za-z]"), ~value.rlike("[0-9]")),
            }
        ),
    }


def features(kind: Column, value: Column, before: Column) -> list[Column]:
    """Binary features of a span, without knowing which pattern found it."""
    long = F.length(value)
    share = F.length(digits(value)) / long
    words = F.split(F.lower(before), "[^a-z]+")
    near = F.lit(False)
    for k, w in CONTEXT.items():
        near = near | ((kind == k) & F.arrays_overlap(words, F.array(*map(F.lit, w))))
    tests = [kind == k for k in KINDS] + [
        long < 10, long.between(10, 20), long > 40, share < 0.2, share > 0.6, near,
        value.contains("@"), value.rlike("[\"']"), value.rlike("[(\\[]"), before.endswith(" ") | (before == ""),
    ]
    return [F.coalesce(t, F.lit(False)).cast("int") for t in tests]


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[tuple[list[float], list[float]]]]:
    """Expectation-maximisation over counted vote patterns.

    Returns the share of true spans and, per labeler, the chances of the votes (-1, 0, 1) given true and given false.
    It starts from the share of agreeing votes, so that "true" is the side most labelers speak for.
    """
    n = sum(count for _, count in patterns)
    truth = [0.5 + 0.45 * sum(v) / max(1, len(v)) for v, _ in patterns]
    prior, tables = 0.5, []
    for _ in range(rounds):
        prior = sum(t * c for t, (_, c) in zip(truth, patterns, strict=True)) / n
        prior = min(max(prior, 0.01), 0.99)
        tables = []
        for k in range(len(patterns[0][0])):
            true, false = [1.0] * 3, [1.0] * 3
            for t, (v, c) in zip(truth, patterns, strict=True):
                true[v[k] + 1] += t * c
                false[v[k] + 1] += (1 - t) * c
            tables.append(([x / sum(true) for x in true], [x / sum(false) for x in false]))
        truth = [posterior(v, prior, tables) for v, _ in patterns]
    return prior, tables


def posterior(vote: tuple[int, ...], prior: float, tables: list) -> float:
    odds = math.log(prior / (1 - prior))
    for v, (true, false) in zip(vote, tables, strict=True):
        odds += math.log(true[v + 1] / false[v + 1])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def logistic(rows: list[tuple[tuple[int, ...], float, float]], ridge: float = 1.0, rounds: int = 400) -> list[float]:
    """Weights (the bias first) from rows of feature pattern, soft label and count, by gradient steps."""
    n = sum(count for _, _, count in rows)
    weights = [0.0] * (len(rows[0][0]) + 1)
    step = 4.0 / len(weights)
    for _ in range(rounds):
        slope = [ridge * w / n for w in weights]
        for x, soft, count in rows:
            miss = (1 / (1 + math.exp(-max(-30.0, min(30.0, weights[0] + sum(w for w, on in zip(weights[1:], x, strict=True) if on))))) - soft) * count / n
            slope[0] += miss
            for k, on in enumerate(x):
                if on:
                    slope[k + 1] += miss
        weights = [w - step * s for w, s in zip(weights, slope, strict=True)]
    return weights


def trained(rows: DataFrame) -> list[float] | None:
    """The span classifier's weights from all items of ``searched`` rows; None without items."""
    parts = [F.transform(f"base_{k}", _item(k, True)) for k in BASE] + [F.transform(f"loose_{k}", _item(k, False)) for k in LOOSE]
    items = rows.select(F.explode(F.concat(*parts)).alias("i")).select("i.*")
    kind, value, before = F.col("kind"), F.col("value"), F.col("before")
    voted = votes(kind, value, before, F.col("base"))
    each = items.select(F.array(*[v.cast("int") for v in voted.values()]).alias("v"), F.array(*features(kind, value, before)).alias("x"))
    counts = [(tuple(r[0]), tuple(r[1]), r[2]) for r in each.groupBy("v", "x").count().collect()]  # bounded by patterns
    if not counts:
        return None
    by_vote: dict[tuple[int, ...], int] = {}
    for v, _, n in counts:
        by_vote[v] = by_vote.get(v, 0) + n
    prior, tables = reliabilities(sorted(by_vote.items()))
    soft: dict[tuple[int, ...], list[float]] = {}
    for v, x, n in counts:
        held = soft.setdefault(x, [0.0, 0.0])
        held[0] += posterior(v, prior, tables) * n
        held[1] += n
    return logistic([(x, s / n, n) for x, (s, n) in sorted(soft.items())])


def accepted(weights: list[float], kind: str):
    """Whether the classifier takes a span of this kind."""

    def test(span: Column) -> Column:
        score = F.lit(weights[0])
        for w, feature in zip(weights[1:], features(F.lit(kind), span["value"], span["before"]), strict=True):
            score = score + w * feature
        return score >= 0

    return test


def listed(kind: str, column: Column) -> Column:
    return F.transform(column, lambda s: F.concat(F.lit(f"{kind}:"), s["start"], F.lit(":"), s["end"]))


def found_spans(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``carry`` columns and, per kind, the base and the added spans."""
    rows = settled(searched(docs, text, carry), "spans")
    weights = trained(rows)
    own = [F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)]
    none = F.expr(f"cast(array() as {SPAN})")
    added = {k: F.filter(f"loose_{k}", accepted(weights, k)) if k in LOOSE and weights else none for k in KINDS}
    return rows.select(
        *own, *[f"base_{k}" for k in BASE], *[F.array_sort(F.concat(F.col(f"base_{k}"), added[k]) if k in BASE else added[k]).alias(f"all_{k}") for k in KINDS]
    )


NEW = "n_email n_ip n_card n_phone base_sha256 spans n_added".split()


def personal_data(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, the base counts, the digest of the base spans, all spans as text, and the number added.

    One row per row; null is the empty text, without spans. Spans are ``kind:start:end`` in code points, end exclusive,
    by kind as in ``KINDS``, then start. Matches that fail their rule are dropped without another try. An added span
    never overlaps a base span. Without any item nothing is trained or added. Carried columns named like a new one
    are replaced.
    """
    carry = [c for c in carry if c.lower() not in NEW]
    rows = found_spans(docs, text, list(carry))
    base = F.concat(*[listed(k, F.col(f"base_{k}")) for k in BASE])
    every = F.concat(*[listed(k, F.col(f"all_{k}")) for k in KINDS])
    counts = [F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in BASE]
    return rows.select(
        *carry, *counts, F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"), F.concat_ws(",", every).alias("spans"),
        (F.size(every) - F.size(base)).cast("long").alias("n_added"),
    )


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs``, each span of the text replaced by ``<KIND>``. Null texts stay null.

    Spans may overlap between kinds; of overlapping ones the first to start (then the longest) is replaced, and the
    rest of what the others cover goes with it.
    """
    kept = [f"_k{i}" for i in range(len(docs.columns))]
    plain = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(docs.columns, kept, strict=True)])
    text_at = kept[[c.lower() for c in docs.columns].index(text.lower())]
    rows = found_spans(plain, text_at, kept)
    each = [F.transform(f"all_{k}", _cut(k)) for k in KINDS]
    rows = rows.select(*kept, F.array_sort(F.concat(*each)).alias("cuts"))

    def step(state: Column, cut: Column) -> Column:
        end = -cut["back"]
        head = F.substring(F.col(text_at), (state["at"] + 1).cast("int"), (cut["start"] - state["at"]).cast("int"))
        begins = cut["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], end).alias("at"),
            F.when(begins, F.concat(state["out"], F.array(head, cut["mask"]))).otherwise(state["out"]).alias("out"),
        )

    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    tail = lambda state: F.concat(
        F.array_join(state["out"], ""), F.substring(F.col(text_at), (state["at"] + 1).cast("int"), F.length(text_at))
    )
    new = F.when(F.size("cuts") > 0, F.aggregate("cuts", empty, step, tail)).otherwise(F.col(text_at))
    return rows.select(*[(new if k == text_at else F.col(k)).alias(c) for c, k in zip(docs.columns, kept, strict=True)])
