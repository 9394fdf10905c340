"""Secret scan with a trigram inverted index, in DataFrame functions only.

From each rule's expression a Boolean query over trigrams is derived. The index holds a posting
(trigram, document) for every trigram that some rule asks for; postings of a document are intersected
by evaluating the queries over one aggregation. A rule's candidates are then verified with the
expression itself. Rules without mandatory trigrams are scanned over every text.

Positions are code points, ends exclusive. Splitting a text at the matches gives the gaps between
them, and lengths of gaps and matches add up to positions.

Defined results: a null text counts as empty and has no spans; documents that repeat a doc_id with the
same text get the same result row each; a null doc_id is kept as null. An empty table gives no rows.
Other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import named, text_or_empty
from .trigrams import Query, query_of, trigrams_of


@dataclass(frozen=True)
class Rule:
    """``group``: the group whose length counts; ``at_least``: that length. A match that is too short is
    dropped and what it covers is not searched again."""

    kind: str
    pattern: str
    group: int = 0
    at_least: int = 0


#: Fixed rules, in the order in which kinds are listed.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # a run of at least 24: the same spans as every run, of which the short ones are dropped
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+", 0, 30),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
)
RULES = BASE_RULES + MORE_RULES


def _key() -> Column:
    """What postings and spans know a document by: id and content, so repeated ids do not mix."""
    return F.struct(F.col("doc_id").cast("long").alias("i"), F.unhex(F.md5(text_or_empty())).alias("m"))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("key", _key())


def postings(texts: DataFrame, wanted: set[str]) -> DataFrame:
    """(trigram, key): the part of the inverted index that the rules can ask for."""
    low = texts.select("key", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in sorted(wanted))))
    return low.select("key", F.explode(found).alias("trigram"))


def _holds(query: Query, has: dict[str, Column]) -> Column:
    if isinstance(query, str):
        return has[query]
    return reduce((lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b), (_holds(p, has) for p in query[1:]))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, rules): the rules whose trigram query a document's postings satisfy."""
    queries = {r.kind: query_of(r.pattern) for r in rules}
    wanted = sorted(set().union(*map(trigrams_of, queries.values())))
    flags = index.groupBy("key").agg(*(F.bool_or(F.col("trigram") == t).alias(f"t{i}") for i, t in enumerate(wanted)))
    has = {t: F.col(f"t{i}") for i, t in enumerate(wanted)}
    hit = F.array_compact(F.array(*(F.when(_holds(q, has), F.lit(k)) for k, q in queries.items())))
    return flags.select("key", hit.alias("rules")).where(F.size("rules") > 0)


def _matches(texts: DataFrame, rule: Rule) -> DataFrame:
    """(key, kind, start, end, and both in bytes) of a rule's matches in texts that have any."""
    hits = texts.where(F.rlike("text", F.lit(rule.pattern))).select(
        "key",
        F.split("text", rule.pattern, -1).alias("gaps"),
        F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)).alias("found"),
        F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)).alias("counted"),
    )
    each = hits.select("key", F.posexplode(F.arrays_zip("found", "counted", F.slice("gaps", F.lit(1), F.size("found")).alias("gap"))).alias("n", "m"))
    sized = each.select("key", "n", F.char_length("m.gap").alias("g"), F.char_length("m.found").alias("l"), F.char_length("m.counted").alias("c"), F.octet_length("m.gap").alias("bg"), F.octet_length("m.found").alias("bl"))
    sized = sized.dropDuplicates(["key", "n"])  # rows repeated in the input
    before = Window.partitionBy("key").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("g") + F.col("l")).cast("long")).over(before)
    return (
        sized.withColumn("end", end)
        .withColumn("byte_end", F.sum((F.col("bg") + F.col("bl")).cast("long")).over(before))
        .where(F.col("c") >= rule.at_least)
        .select("key", F.lit(rule.kind).alias("kind"), (F.col("end") - F.col("l")).alias("start"), "end", (F.col("byte_end") - F.col("bl")).alias("byte_start"), "byte_end")
    )


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, kind, start, end, byte_start, byte_end): one row for each span."""
    texts = keyed(docs)
    free = [r for r in rules if query_of(r.pattern) is True]
    asked = tuple(r for r in rules if query_of(r.pattern) is not True)
    found = [_matches(texts, r) for r in free]
    if asked:
        wanted = set().union(*(trigrams_of(query_of(r.pattern)) for r in asked))
        chosen = texts.join(candidates(postings(texts, wanted), asked), "key")
        found += [_matches(chosen.where(F.array_contains("rules", r.kind)), r) for r in asked]
    return reduce(DataFrame.unionByName, found)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each document: key, doc_id and its spans as an array of (start, rank of kind, kind, end)."""
    order = {r.kind: i for i, r in enumerate(rules)}
    rank = F.create_map(*(F.lit(x) for kv in order.items() for x in kv))
    spans = find_secrets(docs, rules).select("key", F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "end").alias("span"))
    return (
        keyed(docs)
        .select("key", F.lit(None).cast(spans.schema["span"].dataType).alias("span"), F.lit(1).alias("rows"))
        .unionByName(spans.withColumn("rows", F.lit(0)))
        .groupBy("key")
        .agg(F.array_sort(F.array_distinct(F.collect_list("span"))).alias("spans"), F.sum("rows").alias("rows"))
        .select("key", F.col("key.i").alias("doc_id"), "spans", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("_"))
        .drop("_")
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents, with every span replaced by ``[SECRET]`` and ``n_chars``, where there is one, brought up to date.
    Overlapping spans become one mark. All other columns stay as they are, whatever their names."""
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*(named(c) for c in docs.columns)).alias("row"))
    rows = rows.withColumn("key", F.struct(F.col("row.doc_id").cast("long").alias("i"), F.unhex(F.md5(text)).alias("m")))
    found = find_secrets(docs.select("doc_id", "text"), rules).select("key", "byte_start", "byte_end").distinct()
    # spans that meet or touch are one; what lies between two is cut out of the bytes once, so a text of many secrets takes no longer
    upto = Window.partitionBy("key").orderBy("byte_start", "byte_end")
    past = F.max("byte_end").over(upto.rowsBetween(Window.unboundedPreceding, -1))
    apart = found.withColumn("n", F.when(F.col("byte_start") <= past, 0).otherwise(1)).withColumn("n", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    marks = apart.groupBy("key", "n").agg(F.min("byte_start").cast("int").alias("a"), F.max("byte_end").cast("int").alias("b"))
    spans = marks.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))

    def cut(data: Column) -> Column:
        before = lambda i: F.coalesce(F.get("spans", i - 1)["b"], F.lit(0))
        kept = F.transform("spans", lambda s, i: F.concat(F.substring(data, before(i) + 1, s["a"] - before(i)).cast("string"), F.lit("[SECRET]")))
        return F.concat(F.array_join(kept, ""), F.substring(data, F.element_at("spans", -1)["b"] + 1, F.lit((1 << 31) - 1)).cast("string"))

    # a variable of its own, so that the text is turned into bytes once and not for each span
    masked = F.get(F.transform(F.array(text.cast("binary")), cut), F.lit(0))
    done = rows.join(spans, "key", "left").select("row", F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(masked).alias("clean"))
    renewed = {"text": F.col("clean"), "n_chars": F.coalesce(F.char_length("clean").cast("long"), F.lit(None) if "n_chars" not in docs.columns else F.col("row.n_chars").cast("long"))}
    return done.select(*(renewed[c].alias(c) if c in renewed else named("row", c) for c in docs.columns))
