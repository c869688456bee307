"""Personal data: fixed formats as seeds, and contexts learned from them for further identifiers.

Everything is DataFrame functions. Spans are structs (kind, start, end) in code points, end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import documents, stored, wide_key

KINDS = ("email", "ip", "card", "phone")
# The formats with possessive repeats and a start bound: a match can only begin where a run of its
# characters begins or where the last match ended (\G), so long runs are read once.
FORMATS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must have for a format to be tried at all.
NEEDS = {
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]++\.[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"(?:[0-9][\x20-]?){15}[0-9]",
    "phone": r"\+[0-9]",
}
# What a context may discover, from each token with a digit or @ on: digit groups joined over blanks, brackets, dots
# and dashes, up to 19 digits and never a part of a group, or else the token without punctuation behind it.
_END = r"""(?=[.,;:!?"']*+(?:\s|$))"""
GROUPS = r"[+(\[]*+[0-9](?:[\x20()\[\].-]{0,3}+[0-9]){0,18}(?![0-9])[)\]]?+" + _END
TOKEN = r"[^\s0-9@]*+[0-9@]\S*+"
CANDIDATE = rf"""(?<!\S)(?=({GROUPS}|[^\s0-9@]*+[0-9@](?:\S*[^\s.,;:!?"'])?)){TOKEN}"""
CONTEXT_CHARS = 80
FOLD_BLOCK, CHUNK = 128, 4096  # values and characters that are read again for each place in a long text
MASK, BORDER = "\ufdd0", "\ufdd1"  # not characters; for those of a base span and for the ends of a text
ROUNDS, LEAST_SEEDS, CONFIDENCE = 3, 3, 0.8


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})"
                           r"(?:\.0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{0,2})){3}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is made once, also where body uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, fold: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of numbers from 0 on the fold of those before it, 0 for the first.

    Blocks of `FOLD_BLOCK` are folded first and then the values within a block, so a long array is not
    copied for each of its values.
    """
    def fold_all(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), fold)

    def block(at: Column) -> Column:
        return F.floor(at / FOLD_BLOCK).cast("int")

    def before(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), block(F.size(v) - 1)), lambda b: fold_all(
            F.slice(v, b * FOLD_BLOCK + 1, F.lit(FOLD_BLOCK))))
        begins = F.aggregate(blocks, F.array(F.lit(0)), lambda done, x: F.concat(
            done, F.array(fold(F.element_at(done, F.lit(-1)), x))))
        return _let(begins, lambda begin: F.transform(v, lambda _, i: F.aggregate(
            F.slice(v, block(i) * FOLD_BLOCK + 1, i % FOLD_BLOCK), F.get(begin, block(i)), fold)))

    return _let(values, lambda v: F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(before(v)))


def located(text: Column, pattern: str, needs: str) -> Column:
    """All matches of a pattern as structs (match, start, end); an empty list when `needs` is nowhere.

    The texts between matches and the matches alternate, so their lengths give the places. There is one more
    of the former; the last pair has no match.
    """
    spans = "array<struct<match:string,start:int,end:int>>"
    parts = F.struct(F.split(text, pattern, -1).alias("between"),
                     F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def place(p: Column) -> Column:
        lengths = F.transform(p["between"], lambda x, i: F.char_length(x) + F.coalesce(
            F.char_length(F.get(p["found"], i)), F.lit(0)))
        return _let(_running(lengths, lambda a, x: a + x), lambda ends: F.transform(p["found"], lambda m, i: _let(
            F.get(ends, i) + F.char_length(F.get(p["between"], i)), lambda begin: F.struct(
                m.alias("match"), begin.alias("start"), (begin + F.char_length(m)).alias("end")))))

    return F.when(text.rlike(needs), _let(parts, place)).otherwise(F.array()).cast(spans)


def base_spans(text: Column, kind: str) -> Column:
    """Valid matches of a format; failing ones are dropped and not tried again."""
    return F.filter(located(text, FORMATS[kind], NEEDS[kind]), lambda s: _valid(kind, s["match"]))


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _with_kind(spans: Column, kind: str, *names: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        *[(F.lit(kind) if n == "kind" else s[n]).alias(n) for n in names]))


def _chunks(text: Column) -> Column:
    """A text in pieces of `CHUNK` characters, since a place in a long text is found by reading from its start."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.char_length(text) / CHUNK).cast("int")), lambda i: F.substr(
        text, i * CHUNK + 1, F.lit(CHUNK)))


def _cut(chunks: Column, start: Column, length: Column) -> Column:
    """What stands in a text at a place from 0 on."""
    first = F.floor(start / CHUNK).cast("int")
    many = F.floor((start % CHUNK + length) / CHUNK).cast("int") + 1
    return F.substr(F.array_join(F.slice(chunks, first + 1, many), ""), start % CHUNK + 1, length)


def _merged(spans: Column) -> Column:
    """Spans sorted by start as (start, end, kind); overlapping ones become one of the kind of the first."""
    def heads(v: Column) -> Column:
        reach = _running(F.transform(v, lambda s: s["end"]), lambda a, x: F.greatest(a, x))
        marked = _let(reach, lambda r: F.transform(v, lambda s, i: F.struct(s.alias("s"), F.get(r, i).alias("at"))))
        first = F.filter(marked, lambda x: x["s"]["start"] >= x["at"])
        return _let(first, lambda h: F.transform(h, lambda x, i: F.struct(
            x["s"]["start"].alias("start"),
            F.coalesce(F.get(h, i + 1)["at"], F.array_max(F.transform(v, lambda s: s["end"]))).alias("end"),
            x["s"]["kind"].alias("kind"))))

    return _let(spans, heads)


def _replaced(text: Column, spans: Column, by: Callable[[Column], Column]) -> Column:
    """The text with every span of a list sorted by start replaced; overlapping spans become one."""
    def build(x: Column) -> Column:
        chunks, merged = x["chunks"], x["merged"]
        pieces = F.transform(merged, lambda s, i: _let(
            F.coalesce(F.get(merged, i - 1)["end"], F.lit(0)),
            lambda at: F.concat(_cut(chunks, at, s["start"] - at), by(s))))
        last = F.element_at(merged, F.lit(-1))["end"]
        return F.concat(F.array_join(pieces, ""), _cut(chunks, last, x["length"] - last))

    whole = F.struct(_chunks(text).alias("chunks"), _merged(spans).alias("merged"), F.char_length(text).alias("length"))
    return F.when(F.size(spans) == 0, text).otherwise(_let(whole, build))


def _contexts(masked: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """From the chunks of a text, the two words before and after a place, lower case, digits as 0, base spans as one character; the ends
    of the text count as words, and beside one stands the word of the other side. Empty when there are not two."""
    begin = F.greatest(start - CONTEXT_CHARS, F.lit(0))
    before = F.concat(F.when(begin == 0, F.lit(BORDER + " ")).otherwise(""), _cut(masked, begin, start - begin))
    after = _cut(masked, end, F.lit(CONTEXT_CHARS))
    after = F.concat(after, F.when(F.char_length(after) < CONTEXT_CHARS, F.lit(" " + BORDER)).otherwise(""))

    last, first = (F.regexp_extract(w, p, 1) for w, p in ((before, r"(\S+)\s*$"), (after, r"^\s*(\S+)")))

    def words(window: Column, pattern: str, side: str) -> Column:
        two = F.regexp_extract(window, pattern, 1)
        found = F.when(two != BORDER, two).otherwise(F.concat(last, F.lit(" _ "), first))
        found = F.regexp_replace(F.lower(found), "[0-9]", "0")
        found = F.regexp_replace(F.regexp_replace(found, rf"{MASK}+", MASK), r"\s+", " ")
        return F.when(two == "", "").otherwise(F.concat(F.lit(side), found))

    return (words(before, rf"(?:^|\s)(\S+\s+\S+|{BORDER})\s*$", "<"),
            words(after, rf"^\s*(\S+\s+\S+|{BORDER})(?:\s|$)", ">"))


def _facts(docs: DataFrame) -> DataFrame:
    """Per document: base spans, and (context, instance, kind, start, end) of seeds and of candidates that no
    base span touches (kind null), once for the words before and once for those after. Stored; the text is left
    behind."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", wide_key("doc_id", "text").alias("key"), text.alias("text"),
                       *[base_spans(text, k).alias(k) for k in KINDS])
    everything = F.concat(*[_with_kind(F.col(k), k, "kind", "match", "start", "end") for k in KINDS])
    rows = rows.withColumn("base", everything).drop(*KINDS)
    in_order = F.array_sort(F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    rows = rows.withColumn("masked", _replaced(F.col("text"), in_order, lambda s: F.repeat(
        F.lit(MASK), s["end"] - s["start"]))).drop("text")
    # The longest candidate from each token on; it may reach over the next tokens, which have their own.
    tokens = F.arrays_zip(located(F.col("masked"), CANDIDATE, "[0-9@]").alias("place"), F.regexp_extract_all(
        "masked", F.lit(CANDIDATE), F.lit(1)).alias("match"))
    tokens = F.filter(F.transform(tokens, lambda t: F.struct(
        t["match"].alias("match"), t["place"]["start"].alias("start"),
        (t["place"]["start"] + F.char_length(t["match"])).alias("end"))),
        lambda t: t["match"].rlike(r"[\p{L}\p{N}]") & ~F.contains(t["match"], F.lit(MASK)))
    rows = rows.withColumn("tokens", F.when(F.col("masked").rlike("[0-9@]"), tokens).otherwise(
        F.array().cast("array<struct<match:string,start:int,end:int>>")))
    # What follows a candidate is told of the longest one that ends there.
    rows = rows.withColumn("tokens", F.transform("tokens", lambda t, i: F.struct(
        t["match"].alias("match"), t["start"].alias("start"), t["end"].alias("end"),
        ((i == 0) | (t["end"] > F.get(F.col("tokens"), i - 1)["end"])).alias("longest"))))
    rows = rows.withColumn("chunks", _chunks(F.col("masked")))
    fact = "array<struct<context:string,instance:string,kind:string,start:int,end:int>>"

    def facts(spans: Column) -> Column:
        def both(s: Column) -> Column:
            kind = s["kind"]
            left, right = _contexts(F.col("chunks"), s["start"], s["end"])
            return F.array(*[F.struct(
                c.alias("context"), s["match"].alias("instance"), kind.alias("kind"), s["start"].alias("start"),
                s["end"].alias("end")) for c in (left, F.when(s["longest"], right).otherwise(""))])

        return F.flatten(F.transform(spans, both)).cast(fact)

    rows = rows.select("doc_id", "key", "base", F.filter(F.concat(
        facts(F.transform("base", lambda s: s.withField("longest", F.lit(True)))),
        facts(F.transform("tokens", lambda s: s.withField("kind", F.lit(None).cast("string"))))),
        lambda f: f["context"] != "").alias("facts"))
    return stored(rows, "pii")


def learned_patterns(facts: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS,
                     confidence: float = CONFIDENCE) -> DataFrame:
    """(context, kind, confidence) of trusted contexts, from rows (context, instance, kind).

    The graph has an edge for every context and instance seen together; contexts are words before or
    after. A context with enough different seeds of a kind is a pattern of that kind; its confidence is the mean score of its
    instances. Seeds of the kind score 1, of another kind 0. An unseen instance scores nine tenths of what is
    known from its patterns together (1 - product of their doubts). Scores and confidences
    feed each other for some rounds. Then unseen instances that score `confidence` and have at least half of their
    contexts among the trusted ones count as seeds, which may give further patterns, until no pattern is added.
    Counts are combined before the shuffle, so a frequent context is no hot group, and the joins meet one row per
    pattern or instance on one side.
    """
    edges = stored(facts.groupBy("context", "instance").agg(F.max("kind").alias("kind")), "pii-edges")
    own = F.when(F.col("kind") == F.col("pattern_kind"), 1.0).when(F.col("kind").isNotNull(), 0.0)
    trusted = known = None
    while True:
        seeds, seed = edges, F.col("kind")
        if known is not None:
            seeds, seed = edges.join(known, "instance", "left"), F.coalesce("kind", "known_kind")
        counts = seeds.groupBy("context").agg(*[F.count_if(seed == k).alias(k) for k in KINDS])
        most = F.greatest(*[F.col(k) for k in KINDS])
        best = F.coalesce(*[F.when(F.col(k) == most, F.lit(k)) for k in KINDS])
        patterns = counts.filter(most >= least_seeds).select("context", best.alias("pattern_kind"))
        graph = stored(edges.join(patterns, "context"), "pii-graph")

        def scored(instances: DataFrame | None, graph: DataFrame = graph) -> DataFrame:
            rows = graph if instances is None else graph.join(instances, ["instance", "pattern_kind"], "left")
            guess = F.lit(0.0) if instances is None else F.coalesce("score", F.lit(0.0))
            return rows.groupBy("context", "pattern_kind").agg(
                F.avg(F.coalesce(own, guess)).alias("confidence"))

        level, instances = scored(None), None
        for _ in range(rounds):
            doubt = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
            instances = (graph.filter("kind is null").join(level, ["context", "pattern_kind"])
                         .groupBy("instance", "pattern_kind")
                         .agg((0.9 * (1 - F.exp(doubt))).alias("score")))
            instances = stored(instances, "pii-instances")
            level = scored(instances)
        added = level.filter(F.col("confidence") >= confidence).withColumnRenamed("pattern_kind", "kind")
        if trusted is not None:
            added = added.join(trusted, "context", "left_anti")
        added = stored(added, "pii-patterns")
        trusted = added if trusted is None else trusted.unionByName(added)
        if instances is None or added.limit(1).count() == 0:
            return trusted
        # One kind for an instance: that of its best score, the first by name if there are several.
        best = instances.filter(F.col("score") >= confidence).groupBy("instance").agg(
            F.min_by("pattern_kind", F.struct(-F.col("score"), "pattern_kind")).alias("known_kind"))
        mostly = (edges.filter("kind is null").join(trusted.select("context", F.lit(1).alias("in")), "context", "left")
                  .groupBy("instance").agg((2 * F.count("in") >= F.count("*")).alias("mostly")))
        known = stored(best.join(mostly.filter("mostly"), "instance").drop("mostly"), "pii-known")


def _added(rows: DataFrame) -> DataFrame:
    """(key, added): spans of candidates that stand in a trusted context; overlapping ones are one span."""
    facts = rows.select("key", F.explode("facts").alias("f")).select("key", "f.*")
    trusted = learned_patterns(facts.select("context", "instance", "kind"))
    found = (facts.filter("kind is null").drop("kind").join(trusted, "context")
             .groupBy(F.col("key").alias("added_key"))
             .agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("found")))

    return found.select("added_key", F.transform(_merged(F.col("found")), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("added"))


def _ordered(spans: Column) -> Column:
    """`kind:start:end` joined by commas, kinds as listed, then by start."""
    def texts(kind: str) -> Column:
        places = F.array_sort(F.transform(_of_kind(spans, kind), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"))))
        return F.transform(places, lambda s: F.concat_ws(
            ":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*[texts(k) for k in KINDS]), ",")


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                 s["end"].alias("end")))


def find_pii(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of base spans, `base` and `spans` as arrays of (kind, start, end).

    A null text is empty and has none. Spans of different kinds may overlap; added ones touch no base
    span. Rows with equal id and text get the same result, one row each; a null doc_id stays null, an empty
    table gives no row, other columns are left out. Formats are read in one pass over a text of any length.
    """
    rows = _facts(docs)
    added = F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    return (rows.join(_added(rows), F.col("key") == F.col("added_key"), "left")
            .select("doc_id", _plain(F.col("base")).alias("base"),
                    F.concat(_plain(F.col("base")), added).alias("spans")))


def redact(docs: DataFrame) -> DataFrame:
    """Documents with every span replaced by its kind in brackets; overlapping spans become one.

    Columns of any name stay as they are but for `text` and, if there, `n_chars`. A null text stays
    null, repeated rows stay, an empty table stays empty.
    """
    added = _added(_facts(docs))
    text = F.coalesce("text", F.lit(""))
    base = F.concat(*[_with_kind(base_spans(text, k), k, "start", "end", "kind") for k in KINDS])
    more = F.transform(F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>")),
                       lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                          s["kind"].alias("kind")))
    rows = docs.select(F.struct("*").alias("row"), docs["text"].alias("text"), base.alias("base"),
                       wide_key("doc_id", "text").alias("key"))
    joined = rows.join(added, F.col("key") == F.col("added_key"), "left").select(
        "row", "text", F.array_sort(F.concat("base", more)).alias("spans"))

    clean = _replaced(F.col("text"), F.col("spans"), lambda s: F.concat(
        F.lit("["), F.upper(s["kind"]), F.lit("]")))
    out = joined.select("row", clean.alias("clean"))

    def column(name: str) -> Column:
        if name == "text":
            return F.col("clean").alias(name)
        own = F.col("row")[name]
        if name == "n_chars":
            own = F.coalesce(F.char_length("clean").cast(docs.schema[name].dataType), own)
        return own.alias(name)

    return out.select(*[column(c) for c in docs.columns])


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_pii(documents(spark, folder, "doc_id", "text"))
    return found.select(
        "doc_id", *[F.size(_of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_ordered(F.col("base")), 256).alias("base_sha256"),
        _ordered(F.col("spans")).alias("spans"))
