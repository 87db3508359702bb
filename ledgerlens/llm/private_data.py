"""Personal data by bootstrapped contextual extraction (operator 7, DataFrame functions only).

Four base patterns find mail addresses, IP addresses, card and phone numbers in whole texts. They are the seeds: the two
words before a seed, wherever the match before it ends, are a lexical pattern, and every other identifier-like token (with a digit or ``@``) that stands behind
the same words is an instance of that pattern. Over the graph of patterns and instances Spark iterates two scores: a
pattern is as good as the instances that it holds, an instance as good as its best pattern, and a seed is always good.
Patterns that end with a high score and several different seeds discover the remaining instances as spans of kind ``id``.

Only tokens that look like identifiers become rows; texts are never shuffled. Pattern and instance pairs are summed before
the shuffle, so a frequent pattern is no hot group.

Cases: a null or empty text has no spans. Matches never cross documents. Rows that repeat a doc_id are judged by their own
text. An empty table gives no rows. Further columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import let
from ledgerlens.session import stage

KINDS = ["email", "ip", "card", "phone", "id"]
BLANK = r"\x20\x09-\x0D"
# Possessive forms of the base patterns with a look at the character before, so that no run is entered twice.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CANDIDATE = rf"(?<![^{BLANK}])[^{BLANK}0-9@]*+[0-9@][^{BLANK}]*+"
PART = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)"
OPEN, CLOSE, OTHER = "", "", ""  # private-use characters that mark matches
ROUNDS, LEAST_SCORE, LEAST_SEEDS = 3, 0.7, 3
GROUP, LONG = 500, 200


def running(values: Column) -> Column:
    """Sums of all values before each one."""
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("out"))
    step = lambda s, v: F.struct((s["sum"] + v).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out"))
    return F.aggregate(values, start, step, lambda s: s["out"])


def sums_before(values: Column) -> Column:
    """As ``running``, by groups, so that a very long array costs its length times the size of a group."""

    def by_groups(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(v) / GROUP).cast("int") - 1))
        groups = F.transform(numbers, lambda j: F.slice(v, j * GROUP + 1, F.lit(GROUP)))
        total = lambda g: F.aggregate(g, F.lit(0), lambda a, b: a + b)
        add = lambda starts: F.flatten(F.transform(groups, lambda g, j: F.transform(running(g), lambda x: x + F.get(starts, j))))
        return let(running(F.transform(groups, total)), add)

    return let(values, by_groups)


def last_words(text: Column) -> Column:
    """The last three words of the text with the blanks behind them, one for each run."""
    words = F.regexp_extract(text, rf"(?<![^{BLANK}])(?:[^{BLANK}]++[{BLANK}]++){{0,2}}[^{BLANK}]++[{BLANK}]*+$", 0)
    return F.regexp_replace(words, rf"[{BLANK}]+", " ")


def words_before(pieces: Column) -> Column:
    """For each of ``pieces``, which make up a text, the last words of the text to its end.

    Only the last words are carried from piece to piece, by groups as in ``sums_before``.
    """

    def carried(values: Column, first: Column) -> Column:
        start = F.struct(first.alias("last"), F.array().cast("array<string>").alias("out"))

        def step(s, v):
            return let(last_words(F.concat(s["last"], v)), lambda last: F.struct(last.alias("last"), F.concat(s["out"], F.array(last)).alias("out")))

        return F.aggregate(values, start, step, lambda s: s["out"])

    def by_groups(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(v) / GROUP).cast("int") - 1))
        groups = F.transform(numbers, lambda j: F.slice(v, j * GROUP + 1, F.lit(GROUP)))
        ends = carried(F.transform(groups, lambda g: F.array_join(g, "")), F.lit(""))
        start = lambda ends, j: F.when(j > 0, F.get(ends, j - 1)).otherwise("")
        return let(ends, lambda e: F.flatten(F.transform(groups, lambda g, j: carried(g, start(e, j)))))

    return let(pieces, by_groups)


def matches(text: Column, pattern: str) -> Column:
    """Array of (before, value, start, end) of the matches: the last words of the whole text in front, and code points.

    ``text`` must not hold the two marks.
    """
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{OPEN}$0{CLOSE}"))

    def spans(parts: Column) -> Column:
        at = sums_before(F.transform(parts, lambda p: F.length(p)))
        # Parts alternate: text, match, text, ...
        numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor(F.size(parts) / 2).cast("int") - 1))
        fronts = F.transform(numbers, lambda k: F.concat(F.when(k > 0, F.get(parts, 2 * k - 1)).otherwise(""), F.get(parts, 2 * k)))
        found = lambda starts, before: F.transform(
            F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(parts) - 1)), lambda i: (i % 2 == 1) & (i < F.size(parts))),
            lambda i: F.struct(
                F.get(before, F.floor(i / 2).cast("int")).alias("before"), F.get(parts, i).alias("value"),
                F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(F.get(parts, i))).alias("end"),
            ),
        )
        return let(at, lambda starts: let(words_before(fronts), lambda before: found(starts, before)))

    return F.when(F.contains(marked, F.lit(OPEN)), let(F.split(marked, f"[{OPEN}{CLOSE}]"), spans)).otherwise(spans_none())


def spans_none() -> Column:
    return F.array().cast("array<struct<before:string,value:string,start:int,end:int>>")


def luhn(digits: Column) -> Column:
    """True when the digits pass the check sum."""

    def value(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def valid_card(value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)


CHECKS = [
    ("email", EMAIL, lambda v: F.lit(True)),
    ("ip", IP, lambda v: v.rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
    ("card", CARD, valid_card),
    ("phone", PHONE, lambda v: F.length(F.regexp_replace(v, "[^0-9]", "")).between(10, 15)),
]


def lexical_pattern(before: Column) -> Column:
    """The last two words in front, in lower case, with one 9 for each run of digits; null without a word.

    Brackets and quotes that open at the match are none, as ``trimmed`` takes them off candidates. Long words are digested.
    """
    open_ = F.regexp_replace(before, r"(?<![^\x20])[\"'(\[{<]++$", "")
    words = F.regexp_extract(open_, r"(?<![^\x20])((?:[^\x20]++\x20)?[^\x20]++)\x20?$", 1)
    plain = F.regexp_replace(F.lower(words), "[0-9]+", "9")
    return F.when(F.length(plain) > LONG, F.sha2(plain.cast("binary"), 256)).when(plain != "", plain)


def base_spans(text: Column, number: int, pattern: str, valid) -> Column:
    """(start, kind number, end, pattern, value) of the matches that are valid."""

    def span(m: Column) -> Column:
        return F.struct(
            m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"), lexical_pattern(m["before"]).alias("pattern"), m["value"].alias("value")
        )

    return F.transform(F.filter(matches(text, pattern), lambda m: valid(m["value"])), span)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, ``base`` (array of start, kind number, end, pattern, value) and ``rest`` (the same for the other
    identifier-like tokens). The only pass over the texts."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), OPEN + CLOSE, OTHER + OTHER)
    rows = docs.select("doc_id", text.alias("text"))
    for number, (kind, pattern, valid) in enumerate(CHECKS):
        rows = rows.withColumn(kind, base_spans(F.col("text"), number, pattern, valid))
    names = [kind for kind, _, _ in CHECKS]
    base = F.array_sort(F.concat(*names))
    other = F.transform(matches(F.col("text"), CANDIDATE), trimmed)
    rows = rows.withColumn("base", base).withColumn("other", other)
    apart = lambda o: ~F.exists("base", lambda b: (b["start"] < o["end"]) & (b["end"] > o["start"]))
    return rows.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "base", F.filter("other", lambda o: (o["end"] > o["start"]) & apart(o)).alias("rest")
    )


def trimmed(match: Column) -> Column:
    """A candidate without the brackets, quotes and marks around it."""
    lead = F.length(F.regexp_extract(match["value"], r"^[\"'(\[{<]*", 0))
    trail = F.length(F.regexp_extract(match["value"], r"[\"')\]}>.,;:!?]*$", 0))
    value = F.substring(match["value"], lead + 1, F.greatest(F.lit(0), F.length(match["value"]) - lead - trail))
    start = match["start"] + lead
    return F.struct(start.alias("start"), F.lit(4).alias("kind"), (start + F.length(value)).alias("end"), lexical_pattern(match["before"]).alias("pattern"), value.alias("value"))


def scored_patterns(rows: DataFrame, rounds: int, least_score: float, least_seeds: int) -> DataFrame:
    """Patterns that discover instances. ``rows``: pattern, value, seed, one for each place."""
    edges = rows.filter("pattern IS NOT NULL").groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("seed").cast("int")).alias("seed"))
    edges = stage(edges, "pattern-instances")
    seeds = edges.groupBy("pattern").agg(F.sum("seed").alias("seeds")).filter(F.col("seeds") > 0)
    # A pattern without a seed can only get a score through instances that good patterns share with it.
    scores = stage(edges.select("value", F.col("seed").cast("double").alias("score")).groupBy("value").agg(F.max("score").alias("score")), "instances")
    fixed = edges.filter("seed = 1").select("value").distinct().withColumn("known", F.lit(1.0))
    for _ in range(rounds):
        pattern_score = F.sum(F.col("n") * F.col("score")) / (F.sum("n") + 1)
        patterns = stage(edges.join(scores, "value").groupBy("pattern").agg(pattern_score.alias("good")), "patterns")
        best = edges.join(patterns, "pattern").groupBy("value").agg(F.max("good").alias("score"))
        scores = best.join(fixed, "value", "left").select("value", F.coalesce("known", "score").alias("score"))
        scores = stage(scores, "instances")
    return patterns.join(seeds, "pattern").filter((F.col("good") >= least_score) & (F.col("seeds") >= least_seeds)).select("pattern", "good")


def personal_data(docs: DataFrame, rounds: int = ROUNDS, least_score: float = LEAST_SCORE, least_seeds: int = LEAST_SEEDS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_id for every row."""
    rows = stage(scanned(docs), "scanned")
    places = rows.select("doc_id", "text_hash", F.explode(F.concat("base", "rest")).alias("s"))
    places = places.select("doc_id", "text_hash", "s.start", "s.end", "s.pattern", "s.value", (F.col("s.kind") < 4).alias("seed"))
    good = scored_patterns(places, rounds, least_score, least_seeds)
    new = places.filter("NOT seed").join(good, "pattern").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end")).alias("new"))
    new = new.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    joined = rows.join(new, rows["doc_id"].eqNullSafe(new["_id"]) & (rows["text_hash"] == new["_hash"]), "left")
    short = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    names = F.array(*map(F.lit, KINDS))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    every = F.array_sort(F.concat(short, F.coalesce("new", none)))
    count = lambda k: F.size(F.filter("base", lambda b: b["kind"] == k)).cast("bigint")
    return joined.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(written(short).cast("binary"), 256).alias("base_sha256"), written(every).alias("spans"),
        F.size(F.coalesce("new", none)).cast("bigint").alias("n_id"),
    )
