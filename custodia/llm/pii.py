"""Information-theoretic sanitisation of personal data.

Protected entities are the personal data that fixed patterns find: e-mail and IP addresses, payment cards and phone
numbers. How strongly another term reveals an entity is estimated from the corpus: of all occurrences of the term t,
the share p(e|t) that stands within ``reach`` words of a mention of e. Knowing t then leaves -log2 p(e|t) bits of e; it
discloses PMI(e; t) = log2 p(e|t) / p(e). A term that leaves at most ``remove_bits`` is removed, one that leaves at most
``generalise_bits`` is generalised to what kind of word it is, wherever it occurs. A term must disclose at least ``gain``
bits and be seen near the entity in ``support`` different surroundings or texts: copies of one text prove nothing, but a
passage that different texts share does.

Work follows mentions, not documents: terms near mentions are counted against each other in one aggregation, whole
counts are taken only of terms that have support, and occurrences are found through a Bloom filter of fixed size; what
it lets through is joined exactly.

Positions are code points, ends exclusive. Defined results: a null text counts as empty; rows that repeat a doc_id
with the same text give the same spans each; a null doc_id is kept; an empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import materialise, named, parts, text_or_empty

REACH, SUPPORT, REMOVE_BITS, GENERALISE_BITS, GAIN = 8, 3, 0.1, 0.5, 6.0
#: Bits of the filter: fixed, so what is broadcast is too.
FILTER_BITS = 1 << 23

KINDS = ("email", "ip", "card", "phone")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOTTED = re.compile(r"\.[0-9]+\.[0-9]")
_TOKEN = re.compile(r"\S+")
#: Not part of a term at its ends.
EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~…«»„“”‘’¿¡"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def entities(text: str) -> list[tuple[int, int, int]]:
    """(rank of kind, start, end) of the base spans, by kind and start."""
    out = []
    if "@" in text:
        done = 0
        for m in _AT.finditer(text):
            start = m.start()
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((0, start, m.end()))
                done = m.end()
    if _DOTTED.search(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def entity_key(kind: int, value: str) -> str:
    """One name for the ways to write an entity."""
    return f"{KINDS[kind]}:{value.lower() if kind < 2 else ''.join(c for c in value if c.isdigit())}"


def term_of(token: str) -> str:
    return token.strip(EDGES).lower()


def terms(text: str, a: int = 0, b: int | None = None):
    """(start, end, term) of the words of text[a:b]."""
    for m in _TOKEN.finditer(text, a, len(text) if b is None else b):
        word = m[0].strip(EDGES)
        if word:
            start = m.start() + m[0].index(word)
            yield start, start + len(word), word.lower()


def _positions(term: str) -> list[int]:
    """Bits of a term in the filter."""
    import xxhash

    h = xxhash.xxh3_128_intdigest(term.encode("utf-8", "surrogatepass"))
    a, b = h & 0xFFFFFFFF, h >> 64 | 1
    return [(a + i * b) % FILTER_BITS for i in range(4)]


def _texts(docs: DataFrame) -> DataFrame:
    """(id, key, text): a row's key is its id and its content, so repeated ids do not mix."""
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.md5("text")))


class Cover:
    """What spans cover, as intervals in order."""

    def __init__(self, spans: list[tuple[int, int, int]]) -> None:
        self.starts, self.ends = [], []
        for _, start, end in sorted(spans, key=lambda s: s[1:]):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        """Whether a stretch has a place in common with a span."""
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end


def _before(text: str, end: int, reach: int) -> list[tuple[int, int, str]]:
    """The last ``reach`` words of text[:end]: as much of it is looked at as holds them."""
    size = 16 * reach
    while True:
        a = max(0, end - size)
        found = list(terms(text, a, end))
        # a word that the window cuts is not whole
        if a and found and not text[a - 1].isspace() and not any(c.isspace() for c in text[a : found[0][0]]):
            del found[0]
        if len(found) >= reach or not a:
            return found[-reach:] if reach else []
        size *= 2


def _near(text: str, spans: list[tuple[int, int, int]], reach: int):
    """(entity, words near it) of each mention: ``reach`` words on each side, however long they are."""
    taken = Cover(spans)
    for kind, start, end in spans:
        left = _before(text, start, reach)
        right = [t for _, t in zip(range(reach), terms(text, end))]
        yield entity_key(kind, text[start:end]), [t for a, b, t in left + right if not taken.meets(a, b)]


def disclosing(docs: DataFrame, reach: int = REACH, support: int = SUPPORT, remove_bits: float = REMOVE_BITS, generalise_bits: float = GENERALISE_BITS, gain: float = GAIN) -> DataFrame:
    """(term, action, bits_left, bits_gained): the terms to sanitise; action is "remove" or "generalise"."""
    texts = _texts(docs)

    def mentions(batches):
        import hashlib

        for b in (part for whole in batches for part in parts(whole, 4 << 20)):
            rows = []
            for t in b.column("text").to_pylist():
                spans = entities(t)
                own = hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest() if spans else b""
                for entity, ws in _near(t, spans, reach):
                    around = hashlib.blake2b(own + "\0".join(ws).encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
                    rows += [(entity, w, around, n) for w, n in Counter(ws).items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["entity", "term", "around", "n"])

    near = texts.select("text").mapInArrow(mentions, "entity string, term string, around string, n long")
    # one surrounding counts once in a text and its copies, however often it is repeated there
    seen = materialise(near.groupBy("entity", "term", "around").agg(F.sum("n").alias("n")), "mentions")
    pairs = materialise(seen.groupBy("entity", "term").agg(F.count("*").alias("places"), F.sum("n").alias("near")).where(F.col("places") >= support), "pairs")
    wanted = pairs.select("term").distinct()
    bits = _filter(wanted)

    def count(batches):
        for b in (part for whole in batches for part in parts(whole, 4 << 20)):
            c: Counter = Counter()
            for t in b.column("text").to_pylist():
                c.update(t.split())
            totals: Counter = Counter()
            for token, n in c.items():
                totals[term_of(token)] += n
            found = [(t, n) for t, n in totals.items() if t and _may_hold(bits.value, t)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*found)], names=["term", "n"])

    totals = texts.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("total"))
    spaces = F.char_length("text") - F.char_length(F.replace("text", F.lit(" "), F.lit("")))
    size = max(1, texts.agg(F.sum(spaces + 1)).first()[0] or 1)
    mentioned = seen.groupBy("entity").agg(F.sum("n").alias("mentioned"))
    scored = pairs.join(totals, "term").join(mentioned, "entity")
    left = -F.log2(F.least(F.col("near") / F.col("total"), F.lit(1.0)))
    gained = F.log2(F.lit(float(size)) / F.col("mentioned")) - left
    close = scored.select("term", left.alias("bits_left"), gained.alias("bits_gained")).where((F.col("bits_left") <= generalise_bits) & (F.col("bits_gained") >= gain))
    least = close.groupBy("term").agg(F.min("bits_left").alias("bits_left"), F.max("bits_gained").alias("bits_gained"))
    return least.select("term", F.when(F.col("bits_left") <= remove_bits, "remove").otherwise("generalise").alias("action"), "bits_left", "bits_gained")


def _filter(terms: DataFrame):
    """A broadcast Bloom filter of ``terms``; its value is None if there are none."""

    def positions(batches):
        for b in batches:
            at = np.array([p for t in b.column(0).to_pylist() for p in _positions(t)], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // 64), pa.array(at % 64)], names=["cell", "bit"])

    rows = terms.mapInArrow(positions, "cell long, bit long").groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits")).collect()  # FILTER_BITS / 64 rows at most
    cells = np.zeros(FILTER_BITS // 64, np.int64)
    for r in rows:
        cells[r["cell"]] = r["bits"]
    return terms.sparkSession.sparkContext.broadcast(cells.tobytes() if rows else b"")


def _may_hold(bits: bytes, term: str) -> bool:
    return bool(bits) and all(bits[p >> 3] >> (p & 7) & 1 for p in _positions(term))


SPANS = "key string, doc_id long, spans array<struct<kind:string,start:long,end:long,term:string>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("term", pa.string())]))


def find(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text, spans for every row: spans are (kind, start, end) by kind and start; kinds are the entities' and, of
    other terms, "generalise" and "remove"."""
    known_terms = materialise(disclosing(docs, **options), "terms")
    bits = _filter(known_terms.select("term"))
    texts = _texts(docs)

    def scan(batches):
        keep, known = bits.value, {}

        def wanted(token):
            if token not in known:
                if len(known) > 200_000:
                    known.clear()
                known[token] = _may_hold(keep, term_of(token))
            return known[token]

        for b in (part for whole in batches for part in parts(whole, 4 << 20)):
            out = []
            for t in b.column("text").to_pylist():
                found = entities(t)
                spans = [{"kind": KINDS[k], "start": s, "end": e, "term": None} for k, s, e in found]
                if keep and any(map(wanted, set(t.split()))):
                    taken = Cover(found)
                    for start, end, w in terms(t):
                        if wanted(w) and not taken.meets(start, end):
                            spans.append({"kind": "term", "start": start, "end": end, "term": w})
                out.append(spans)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("doc_id"), pa.array(out, _SPAN)], names=["key", "doc_id", "spans"])

    found = materialise(texts.select("key", "doc_id", "text").mapInArrow(scan, SPANS), "spans")
    base = F.filter("spans", lambda s: s["term"].isNull())
    maybe = found.select("key", F.explode("spans").alias("s")).where("s.term is not null").distinct()
    real = maybe.join(known_terms, F.col("s.term") == F.col("term")).select("key", F.struct(F.col("action").alias("kind"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.term").alias("term")).alias("s"))
    more = real.groupBy("key").agg(F.collect_list("s").alias("more"))
    rank = F.create_map(*(F.lit(x) for kv in enumerate((*KINDS, "generalise", "remove")) for x in reversed(kv)))
    by = lambda a, b: F.when(rank[a["kind"]] != rank[b["kind"]], rank[a["kind"]] - rank[b["kind"]]).otherwise((a["start"] - b["start"]).cast("int"))
    every = F.array_sort(F.concat(base, F.coalesce("more", F.array().cast("array<struct<kind:string,start:long,end:long,term:string>>"))), by)
    return found.join(more, "key", "left").select("key", "doc_id", every.alias("spans"))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """The documents with every span replaced: entities by their kind, terms by ``[TERM]`` or the kind of word. All
    columns stay, whatever their names."""
    marks = find(docs.select("doc_id", "text"), **options).where(F.size("spans") > 0).groupBy("key").agg(F.any_value("spans").alias("spans"))

    def rewrite(batches):
        for b in batches:
            out = []
            for t, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                done, at = [], 0
                for s in sorted(spans or [], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] < at:
                        at = max(at, s["end"])
                        continue
                    word = t[s["start"] : s["end"]]
                    general = "[NUMBER]" if word[:1].isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]"
                    done += [t[at : s["start"]], {"remove": "[TERM]", "generalise": general}.get(s["kind"], f"[{s['kind'].upper()}]")]
                    at = s["end"]
                out.append(None if t is None else "".join([*done, t[at:]]))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.string())], names=["row", "clean"])

    rows = docs.select(F.struct(*(named(c) for c in docs.columns)).alias("row"))
    key = F.concat_ws(":", F.coalesce(F.col("row.doc_id").cast("long").cast("string"), F.lit("-")), F.md5(F.coalesce(F.col("row.text").cast("string"), F.lit(""))))
    given = rows.withColumn("key", key).join(marks, "key", "left").select("row", F.col("row.text").alias("text"), "spans")
    done = given.mapInArrow(rewrite, StructType([given.schema["row"], StructField("clean", StringType())]))
    return done.select(*(F.col("clean").alias("text") if c == "text" else named("row", c) for c in docs.columns))
