"""Personal data: fixed patterns first, then bootstrapped contextual extraction.

What the fixed patterns find (e-mail, IP, card, phone) are the seed entities. The one and two words before and
behind an entity are lexical patterns. Instances are all seeds, whatever their shape, and all other tokens that
look like an identifier: numbers whose groups may be parted by spaces, and tokens with two digits or an @. Patterns
and values form a bipartite graph. Spark scores it in steps of a few rounds: a pattern's confidence in a kind is
the mean score of its distinct values (smoothed, and only with enough distinct values of support), and an unseen
value's score combines its patterns' confidences. Support are the seeds, and after a step also the values that
confident patterns have found; so patterns without a seed of their own enter in later steps. Confident patterns
keep their confidence, and scores by others end with the step, so that nothing raises itself from step to step.
Steps go on until no pattern becomes confident; confident patterns mark the unseen identifiers beside them.

Native: DataFrame operations only. Matches and their places come from the same regular expression, once
to extract and once to split; possessive quantifiers and anchors keep it linear and without recursion on
very long runs. The graph holds each pattern and value once, so a pattern that stands in a third of all
documents is combined before it is shuffled.

Defined cases: a null text counts as empty (no spans); repeated rows are each searched, and their values
count once in the graph; without seeds no pattern is learned; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aridspan.llm.common import stored, table
from aridspan.llm.decontamination import let

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns, written so that they find the same matches in linear time: a match can only
# begin where its run of characters begins, or where the last match ended (\G).
_NAME = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
IP = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

#: What parts tokens besides white space, and the cue that may stand before a value in one token.
_PART = r"\s\"',;|<>(){}\[\]"
CUE = r"\p{L}[\p{L}_-]{1,31}+[:=#]++"
#: Numbers in groups, with spaces between groups of two digits or more; tokens of 6 to 256 characters with two digits or an @.
_END = r"(?![\p{L}\p{N}_@])"
_NUMBER = rf"\+?+(?:\([0-9]++\)\x20?+)?+[0-9]++{_END}(?:(?:[().\-/]{{1,2}}+[0-9]++|[().\-/]?+\x20[().\-/]?+[0-9]{{2,}}+){_END})*+"
_TOKEN = rf"(?=[^{_PART}]{{6,290}}(?![^{_PART}]))(?=[^@{_PART}]*+@|(?:[^0-9{_PART}]*+[0-9]){{2}})[^{_PART}]++"
TOKEN = rf"(?<![^{_PART}])(?:(?:{CUE})?+{_NUMBER}|{_TOKEN})"
#: Characters before and behind a value in which its words are looked for.
WINDOW = 130

#: Distinct seeds or found values that a pattern needs, rounds of a step, smoothing, and the confidence from which a pattern
#: marks identifiers.
MIN_SEEDS, ROUNDS, SMOOTH, CONFIDENT = 3, 3, 1.0, 0.6


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def located(text: Column, pattern: str) -> Column:
    """(start, end, text) of each match, in code points."""
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))

    def places(found: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            end = begin + F.char_length(x["m"])
            one = F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("text"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        pairs = F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"))
        return F.aggregate(pairs, start, step, lambda acc: acc["out"])

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, places(found)))


def of_kind(text: Column, kind: str) -> Column:
    """The spans of one kind: kind, start, end."""
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")
    found = located(text, PATTERNS[kind])
    if kind in ("email", "phone"):
        found = F.when(F.instr(text, "@" if kind == "email" else "+") > 0, found)
    n = lambda x: F.length(digits(x["text"]))
    holds = {
        "email": lambda x: F.lit(True),
        "ip": lambda x: F.rlike(x["text"], F.lit(IP)),
        "card": lambda x: n(x).between(16, 19) & F.call_function("luhn_check", digits(x["text"])),
        "phone": lambda x: n(x).between(8, 15),
    }[kind]
    return F.transform(
        F.filter(F.coalesce(found, none), holds),
        lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")),
    )


def base_spans(text: Column) -> Column:
    """All spans of the fixed patterns, by kind as listed, then start."""
    return F.concat(*(of_kind(text, kind) for kind in KINDS))


def written(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def with_base(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns of docs, whatever their names), doc_id, text, text_hash, and base, the array of spans;
    a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", F.xxhash64(text).alias("text_hash"), base_spans(text).alias("base"))


def identifier_like(text: Column) -> Column:
    """(kind, start, end) of the tokens that look like an identifier, without a cue in front or signs of a sentence
    behind; their kind is null."""

    def value(t: Column) -> Column:
        start = t["start"] + F.char_length(F.regexp_extract(t["text"], f"^{CUE}", 0))
        end = t["start"] + F.char_length(F.regexp_replace(t["text"], "[.:!?]++$", ""))
        return F.struct(F.lit(None).cast("string").alias("kind"), start.alias("start"), end.alias("end"), t["text"].alias("text"))

    def fits(v: Column) -> Column:
        n = F.length(digits(v["text"]))
        enough = F.when(F.contains(v["text"], F.lit(" ")), n >= 6).otherwise((n >= 2) | F.contains(v["text"], F.lit("@")))
        return (v["end"] - v["start"]).between(6, 256) & enough

    found = F.when(F.rlike(text, F.lit("[0-9@]")), located(text, TOKEN))
    return F.transform(F.filter(F.transform(found, value), fits), lambda v: v.dropFields("text"))


def contexts(before: Column, behind: Column) -> Column:
    """The patterns of a value: the one and two words before it (``word _``) and behind it (``_ word``), lower-cased; a
    sign : = # belongs to the word before it, and brackets and quotes that the value stands in to no word."""
    left = F.regexp_replace(F.regexp_replace(F.lower(before), r"[\s\"'(\[<{]++$", ""), r"(?<!\s)\s++([:=#]++)$", "$1")
    none = F.array().cast("array<string>")

    def sides(words: Column, last: bool) -> Column:
        n = F.size(words)
        some = lambda k: F.array_join(F.slice(words, n - k + 1, F.lit(k)) if last else F.slice(words, 1, k), " ")
        shown = lambda k: F.concat(some(k), F.lit(" _")) if last else F.concat(F.lit("_ "), some(k))
        return F.when(n >= 2, F.array(shown(1), shown(2))).when(n == 1, F.array(shown(1))).otherwise(none)

    words = lambda t: F.array_remove(F.split(t, r"\s+", -1), "")
    return F.concat(let(words(left), lambda w: sides(w, True)), let(words(F.lower(behind)), lambda w: sides(w, False)))


def occurrences(rows: DataFrame) -> DataFrame:
    """doc_id, text_hash, kind, start, end, value, patterns, for each base span and each identifier-like token beside
    them (kind: null). rows: as with_base makes them. value is a hash of what stands there without spaces, brackets, - and /."""
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    free = F.filter(
        F.coalesce(identifier_like(text), none),
        lambda v: ~F.exists("base", lambda s: (s["start"] < v["end"]) & (s["end"] > v["start"])),
    )
    each = rows.select("doc_id", "text_hash", "text", F.explode(F.concat("base", free)).alias("v"))
    value = F.substring(text, F.col("v.start") + 1, F.col("v.end") - F.col("v.start"))
    before = F.substring(text, F.greatest(F.lit(1), F.col("v.start") - (WINDOW - 1)), F.least(F.lit(WINDOW), F.col("v.start")))
    behind = F.substring(text, F.col("v.end") + 1, F.lit(WINDOW))
    return each.select(
        "doc_id", "text_hash", "v.*",
        F.md5(F.translate(F.lower(value), " ()-/", "").cast("binary")).alias("value"),
        contexts(before, behind).alias("patterns"),
    )


def combined(unseen: DataFrame, patterns: DataFrame) -> DataFrame:
    """value, kind, score of unseen (pattern, value) by patterns (pattern, kind, confidence)."""
    none_right = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999))))
    return unseen.join(patterns, "pattern").groupBy("value", "kind").agg((1 - F.exp(none_right)).alias("score"))


def confident_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind, confidence of the patterns that mark identifiers; found: as occurrences makes them."""
    graph = stored(found.select(F.explode("patterns").alias("pattern"), "value").distinct(), "graph")
    seeds = stored(found.filter("kind IS NOT NULL").select("value", "kind", F.lit(1.0).alias("score")).distinct(), "seeds")
    size = stored(graph.groupBy("pattern").agg(F.count("*").alias("n")), "sizes")
    strange = stored(graph.join(seeds, "value", "left_anti"), "strange")
    support, unseen, known = seeds, strange, None
    while True:
        held = graph.join(support, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("held"), F.count("*").alias("k"))
        held = held.filter(F.col("k") >= MIN_SEEDS).join(size, "pattern")
        if known is not None:
            held = held.join(known, ["pattern", "kind"], "left_anti")
        held = stored(held, "support")
        if held.isEmpty():
            break
        patterns = None
        for _ in range(rounds):
            sums = held.withColumn("s", F.lit(0.0))
            if patterns is not None:
                guess = unseen.join(combined(unseen, patterns), "value").groupBy("pattern", "kind").agg(F.sum("score").alias("s"))
                sums = held.join(guess, ["pattern", "kind"], "left").withColumn("s", F.coalesce("s", F.lit(0.0)))
            confidence = (F.col("held") + F.col("s")) / (F.col("n") + SMOOTH)
            patterns = stored(sums.select("pattern", "kind", confidence.alias("confidence")), "patterns")
        new = patterns.filter(F.col("confidence") >= CONFIDENT)
        if new.isEmpty():
            break
        known = new if known is None else known.unionByName(new)
        values = stored(combined(strange, known), "found")
        support, unseen = seeds.unionByName(values), strange.join(values, "value", "left_anti")
    return graph.sparkSession.createDataFrame([], "pattern string, kind string, confidence double") if known is None else known


def find_private(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns of docs), base and extra for each row of docs (doc_id, text): arrays of (kind, start,
    end) of the fixed patterns, and of unseen identifiers, whose kind is ``found_`` and the kind of the seeds that
    taught the most confident pattern beside them."""
    rows = with_base(docs)
    found = stored(occurrences(rows.select("doc_id", "text", "text_hash", "base")), "instances")
    patterns = confident_patterns(found)
    place = ["doc_id", "text_hash", "start", "end"]
    span = F.struct(F.concat(F.lit("found_"), F.col("found_kind")).alias("kind"), "start", "end")
    extra = (
        found.filter("kind IS NULL")
        .select(*place, F.explode("patterns").alias("pattern"))
        .join(patterns.withColumnRenamed("kind", "found_kind"), "pattern")
        .groupBy(*place)
        .agg(F.max_by("found_kind", F.struct("confidence", "found_kind")).alias("found_kind"))
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set(span)).alias("extra"))
    )
    joined = rows.join(extra, rows["doc_id"].eqNullSafe(extra["doc_id"]) & (rows["text_hash"] == extra["text_hash"]), "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    return joined.select("row", "base", F.coalesce("extra", none).alias("extra"))


def redacted(text: Column, spans: Column) -> Column:
    """text with each span replaced by its kind in brackets; overlapping spans are replaced together."""
    ordered = F.array_sort(spans, lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(y["end"] - x["end"]))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), label)
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], piece).otherwise(acc["out"]).alias("out")
        )

    whole = F.aggregate(
        ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and the number of spans that the method added."""
    found = find_private(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "row.doc_id",
        *(count(kind) for kind in KINDS),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.concat("base", "extra")).alias("spans"),
        F.size("extra").cast("long").alias("n_extra"),
    )
