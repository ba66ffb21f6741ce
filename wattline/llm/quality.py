"""Quality rules by the divergence of a document from its language, in DataFrame functions only.

Each document gives two histograms: characters by class, and words by common word (all others in one bin). The
references are the mean histograms of the documents of each language, over all documents. A document is kept if, for
some language, both Jensen-Shannon distances are small enough; short documents pass, their histograms say little.
Documents that fail the plain base rules are not kept.

Distances fall with length, so the limits go by language and length (half doublings of the words): the median of all
documents of that language and length and ``SPREADS`` times the way from the lower quartile to it. The upper half, where
the bad documents are, has no say, whatever their share. With few documents of a length those of all languages count
together, and with few of these, too, the limit of the next shorter length holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import SEPARATORS
from wattline.session import settled

# Frequent function words of four languages.
COMMON = {
    "de": "der die das und in zu den von mit ist des im nicht ein eine als auch auf dem sich für an es er".split(),
    "en": "the of and to in a is that for it as with be on by this he at from are was an or which".split(),
    "es": "de la que el en y los del se las por un para con no una su al lo como más o es este".split(),
    "fr": "de la le et les des en un une du que est pour qui dans par au sur pas plus ce il elle aux".split(),
}
VOCABULARY = sorted({w for words in COMMON.values() for w in words})
SYMBOLS = "#*$%&|<>"
#: Guards and limits: distances are judged from so many words on; the largest distances where there are too few documents.
GUARD = 100
CHARS, WORDS = 0.30, 0.50
#: The limit in ways from the lower quartile to the median, the least such way, and the documents that a limit needs.
SPREADS, WAY, ENOUGH = 6, 0.01, 50

MIN_WORDS, REPEATED = 50, 50


def size_of(array: Column) -> Column:
    return F.size(array).cast("long")


def total(array: Column, zero: str = "0D") -> Column:
    return F.aggregate(array, F.expr(zero), lambda x, y: x + y)


def measured(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """``carry`` columns, the base counts and the two histograms as arrays of counts."""
    own = [f"_{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(carry, own, strict=True)], F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    trimmed = F.btrim("t", F.lit(SEPARATORS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SEPARATORS)) != "")
    # Most characters are lower-case letters; the other classes share none with them and are counted in what is left.
    rows = rows.withColumn("rest", F.regexp_replace("t", "\\p{Ll}+", ""))
    without = lambda pattern: F.length(F.regexp_replace("rest", pattern, "")).cast("long")
    rows = rows.select(
        *own,
        F.length("t").cast("long").alias("n_chars"),
        F.length("rest").cast("long").alias("no_lower"),
        words.alias("w"),
        lines.alias("lines"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        without(f"[{SYMBOLS}]+").alias("no_symbols"),
        without("\\p{Lu}+").alias("no_upper"),
        without("[0-9]+").alias("no_digits"),
        without("[.,;:!?'\"()-]+").alias("no_marks"),
    )
    count = lambda c: F.col("no_lower") - F.col(c)
    chars = [F.col("n_chars") - F.col("no_lower"), *map(count, ("no_upper", "no_digits", "no_marks", "no_symbols")), F.col("n_chars") - F.col("word_chars")]
    chars.append(F.col("n_chars") - reduce(lambda x, y: x + y, chars))
    windows = F.transform(
        F.expr("slice(w, 1, greatest(size(w) - 2, 0))"),
        lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)),
    )
    common = F.filter(F.transform("w", F.lower), lambda x: x.isin(VOCABULARY))
    rows = rows.select(
        *own,
        size_of(F.col("w")).alias("n_words"),
        "word_chars",
        count("no_symbols").alias("n_symbols"),
        (size_of(F.col("lines")) - size_of(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.array(*chars).alias("chars"),
        common.alias("common"),
        windows.alias("h"),
    )
    # Only texts with a repeated window are sorted; equal windows are then neighbours.
    ordered = F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
    )
    # The common words in one string, each between two blanks of its own: searching it for a word costs less than an array.
    bare = F.octet_length("joined")
    hits = lambda c: ((bare - F.octet_length(F.replace("joined", c, F.lit("")))) / F.octet_length(c)).cast("int")
    counts = F.transform(F.array(*[F.lit(f" {w} ") for w in VOCABULARY]), hits)
    counts = F.concat(counts, F.array((F.col("n_words") - F.size("common")).cast("int")))
    rows = rows.withColumn("joined", F.concat(F.lit(" "), F.array_join("common", "  "), F.lit(" "))).select(
        *own, "n_words", "word_chars", "n_symbols", "n_dup_lines", "chars", counts.alias("words"), ordered.alias("ordered")
    )
    twice = F.filter(
        "ordered",
        lambda s, i: F.coalesce(s["x"] == F.get("ordered", i - 1)["x"], F.lit(False))
        | F.coalesce(s["x"] == F.get("ordered", i + 1)["x"], F.lit(False)),
    )
    places = F.sort_array(F.transform(twice, lambda s: s["i"]))
    rows = rows.select(*own, "n_words", "word_chars", "n_symbols", "n_dup_lines", "chars", "words", places.alias("places"))
    steps = F.transform("places", lambda p, i: F.least(F.coalesce(F.get("places", i + 1) - p, F.lit(3)), F.lit(3)).cast("long"))
    repeated = F.coalesce(total(steps, "0L"), F.lit(0).cast("long"))
    return rows.select(
        *[F.col(o).alias(c) for c, o in zip(carry, own, strict=True)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words"), "chars", "words",
    )


def shares(counts: str) -> Column:
    """A histogram of counts as shares; all 0 if there are none."""
    of = lambda sum_of: F.transform(counts, lambda x: F.coalesce(F.try_divide(x.cast("double"), sum_of), F.lit(0.0)))
    # The sum is handed over: named inside the last step it would be added up again for every count.
    return F.aggregate(F.transform(counts, lambda x: x.cast("double")), F.lit(0.0), lambda x, y: x + y, of)


def distance(p: Column, q: list[float]) -> Column:
    """The Jensen-Shannon distance (root of the divergence, base 2) between a histogram and a reference."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)
    terms = F.zip_with(p, F.array(*[F.lit(float(v)) for v in q]), lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(total(terms) / 2, F.lit(0.0)))


def references(rows: DataFrame, lang: str) -> dict[str, dict[str, list[float]]]:
    """By language with a word list: the mean shares of the documents of that language, for both histograms."""
    known = rows.filter(F.col(lang).isin(sorted(COMMON)))
    out: dict[str, dict[str, list[float]]] = {}
    for kind, bins in (("chars", 7), ("words", len(VOCABULARY) + 1)):
        each = known.select(lang, F.posexplode(kind).alias("bin", "share"))
        for language, k, mean in each.groupBy(lang, "bin").agg(F.avg("share")).collect():  # a row per language and bin
            out.setdefault(language, {}).setdefault(kind, [0.0] * bins)[k] = mean
    return out


def ruled(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    carry: tuple[str, ...] = ("doc_id",),
    chars: float = CHARS,
    words: float = WORDS,
    guard: int = GUARD,
) -> DataFrame:
    """``carry`` columns, the base counts, ``base_failed``, the two distances to the nearest language, and ``kept``.

    One row per row. Null and empty texts have no words: all counts 0, base failed. Null languages, and those without
    a word list, teach nothing but are judged alike. ``chars`` and ``words`` are the limits where too few documents are
    as short. Windows of three words are compared by 64-bit hashes. Without any
    reference the distances are null and only the base rules decide. Carried columns named like a new one are replaced.
    """
    new = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed chars_distance words_distance kept".split()
    carry = [c for c in carry if c.lower() not in new]
    own = [f"_c{i}" for i in range(len(carry))]
    renamed = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(carry, own, strict=True)], F.col(f"`{text}`").alias("_t"), F.col(f"`{lang}`").alias("_lang"))
    rows = measured(renamed, "_t", [*own, "_lang"])
    rows = settled(rows.withColumns({"chars": shares("chars"), "words": shares("words")}), "measured")
    found = references(rows, "_lang")
    known = sorted(found)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    judges = (F.col("n_words") >= guard) & ~failed
    each = lambda kind: F.array(*[distance(F.col(kind), found[x][kind]) for x in known]) if known else F.lit(None).cast("array<double>")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = rows.select(
        *own, "_lang", *counts, failed.alias("base_failed"), judges.alias("judged"), size_band(F.col("n_words")).alias("band"), each("chars").alias("c"), each("words").alias("w")
    )
    rows = settled(rows, "distances")
    most = limits(rows.filter("judged"), known, {"c": chars, "w": words})
    fits = F.lit(not known)
    for k in range(len(known)):
        fits = fits | reduce(lambda x, y: x & y, [F.get(kind, F.lit(k)) <= most[kind][k] for kind in ("c", "w")])
    return rows.select(
        *[F.col(o).alias(c) for c, o in zip(carry, own, strict=True)],
        *counts, "base_failed", F.array_min("c").alias("chars_distance"), F.array_min("w").alias("words_distance"),
        (~F.col("base_failed") & ((F.col("n_words") < guard) | fits)).alias("kept"),
    )


def size_band(n_words: Column) -> Column:
    return F.floor(2 * F.log2(F.greatest(n_words, F.lit(1)).cast("double"))).cast("int")


def limits(rows: DataFrame, known: list[str], fixed: dict[str, float]) -> dict[str, list[Column]]:
    """For both distances and each language: the limit at the row's ``band``, from the documents of that language."""
    place = F.array_position(F.array(*map(F.lit, known)), F.col("_lang")).cast("int") - 1 if known else F.lit(None).cast("int")
    own = rows.withColumn("_at", place).filter("_at >= 0")
    quartiles = [F.percentile_approx(F.get(kind, F.col("_at")), F.lit([0.25, 0.5]), F.lit(10_000)).alias(kind) for kind in fixed]
    told = own.rollup("band", "_at").agg(F.count(F.lit(1)).alias("n"), *quartiles).filter("band IS NOT NULL").collect()  # a row per band and language
    by_place = {(r["_at"], r["band"]): r for r in told if r["n"] >= ENOUGH}
    out: dict[str, list[Column]] = {}
    last = max((r["band"] for r in told), default=0)
    for kind, start in fixed.items():
        for k in range(len(known)):
            now, line = start, []
            for band in range(last + 1):
                if found := by_place.get((k, band)) or by_place.get((None, band)):
                    low, middle = found[kind]
                    now = middle + SPREADS * max(middle - low, WAY)
                line.append(F.lit(float(now)))
            out.setdefault(kind, []).append(F.get(F.array(*line), F.least("band", F.lit(last))))
    return out
