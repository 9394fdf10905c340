import math
import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from custodia.llm import pii

from .util import docs, noisy

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def ok(kind, s):
    digits = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        total = sum((2 * int(d) - 9 * (2 * int(d) > 9)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, (kind, p) in enumerate(PATTERNS) for m in re.finditer(p, text) if ok(kind, m[0])]


ODD = ["a@b.c@d.e x@y @b.c@d.e a..b@c-d.e. é@b.co", "1.2.3.4.5 256.1.1.1 01.02.003.0004 1.2.3 9.9.9.9.9.9.9.9", "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111 1 2", "+49 (30) 123-4567 +1 2 +1234567890123456 ++12345678901", "", "a" * 5000 + "@", "1." * 3000, "1 " * 3000, "+1" * 900, "٣٣@b.c ١.٢.٣.٤"]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.b-+19 (0", max_size=40))
def test_entities_match_patterns(text):
    assert pii.entities(text) == brute(text)


def test_entities_on_odd_texts():
    for t in ODD:
        assert pii.entities(t) == brute(t), t[:30]


def corpus():
    texts = [t for t in noisy(6, 40)] + ODD
    for i in range(6):  # "kestrel" gives ann away, "harbour" half so
        texts.append(f"word{i} met kestrel by harbour ann.k@mail.example.org said{i} note{i}")
    texts += [f"clean{i} harbour text{i} of{i}" for i in range(2)] + ["Kestrel alone"] * 0
    texts += ["same copy only secretword bob@mail.example.org again"] * 5  # copies prove nothing
    texts += [f"Kestrel number {i}" for i in range(0)]
    return texts


def brute_terms(texts, reach, support, remove, general, gain):
    seen, totals, mentioned, size = defaultdict(dict), Counter(), Counter(), 0
    near = Counter()
    for t in texts:
        t = t or ""
        size += t.count(" ") + 1
        totals.update(w for _, _, w in pii.terms(t))
        for e, ws in pii._near(t, brute(t), reach):
            for w, n in Counter(ws).items():
                seen[e, w][tuple(ws)] = 1
                near[e, w] += n
                mentioned[e] += n
    out = {}
    for (e, w), places in seen.items():
        if len(places) >= support:
            left = -math.log2(min(1, near[e, w] / totals[w]))
            if left <= general and math.log2(size / mentioned[e]) - left >= gain:
                out[w] = min(out.get(w, left), left)
    return {w: "remove" if left <= remove else "generalise" for w, left in out.items()}


def test_terms_and_spans_match_brute_force(spark):
    texts = corpus()
    d = docs(spark, texts, odd=True)
    options = {"gain": 3.0}
    want = brute_terms(texts, pii.REACH, pii.SUPPORT, pii.REMOVE_BITS, pii.GENERALISE_BITS, 3.0)
    assert {r.term: r.action for r in pii.disclosing(d, **options).collect()} == want
    assert want["kestrel"] == "remove" and want["harbour"] == "generalise" and "secretword" not in want
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find(d, **options).collect()}
    for i, t in enumerate(texts):
        base = brute(t or "")
        more = [(want[w], a, b) for a, b, w in pii.terms(t or "") if w in want and not any(s < b and a < e for _, s, e in base)]
        every = [(pii.KINDS[k], s, e) for k, s, e in base] + sorted(more, key=lambda x: (x[0] != "generalise", x[1]))
        assert got[i] == every
    clean = {r.doc_id: r.text for r in pii.sanitise(d, **options).collect()}
    at = texts.index("word0 met kestrel by harbour ann.k@mail.example.org said0 note0")
    assert "kestrel" not in clean[at] and "ann.k" not in clean[at] and "[EMAIL]" in clean[at]
    assert all(clean[i] == t for i, t in enumerate(texts) if not got[i])
    assert pii.sanitise(d, **options).columns == d.columns


def test_repeated_null_and_empty(spark):
    d = docs(spark, ["x a@b.cc", "x a@b.cc", None, "y"], ids=[1, 1, None, 1])
    got = sorted((str(r.doc_id), len(r.spans)) for r in pii.find(d).collect())
    assert got == [("1", 0), ("1", 1), ("1", 1), ("None", 0)]
    assert pii.find(docs(spark, [])).count() == 0


def windows(text, reach):
    """Words on both sides of each mention, by splitting the text there."""
    taken = brute(text)
    for _, start, end in taken:
        left, right = list(pii.terms(text[:start]))[-reach:], [(a + end, b + end, w) for a, b, w in pii.terms(text[end:])][:reach]
        yield [w for a, b, w in left + right if not any(s < b and a < e for _, s, e in taken)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="xY-, a@b.c+", max_size=60), st.integers(1, 3))
def test_near_words_match_split_texts(text, reach):
    assert [ws for _, ws in pii._near(text, pii.entities(text), reach)] == list(windows(text, reach))


def test_long_tokens_do_not_hide_words():
    text = f"zero kestrel {'u' * 300} by the harbour {'v' * 300} at x-(ann.k@mail.example.org end"
    assert [ws for _, ws in pii._near(text, pii.entities(text), pii.REACH)] == list(windows(text, pii.REACH)) == [["kestrel", "u" * 300, "by", "the", "harbour", "v" * 300, "at", "x", "end"]]


def test_long_tokens_do_not_hide_disclosing_terms(spark):
    texts = [f"kestrel {'u' * 300}{i} ann.k@mail.example.org said{i}" for i in range(4)] + [f"other{i} text{i}" for i in range(40)]
    assert {r.term: r.action for r in pii.disclosing(docs(spark, texts), gain=3.0).collect()} == {"kestrel": "remove"}


def test_shared_passages_of_different_texts_count(spark):
    line = "call or write to kestrel at ann.k@mail.example.org for any of these many matters now"
    texts = [f"about{i} topic{i} {'x ' * 8}{line} y y y y y" for i in range(4)] + [f"other{i} text{i} " + "z " * 40 for i in range(40)]
    assert {r.term: r.action for r in pii.disclosing(docs(spark, texts), gain=3.0).collect()}["kestrel"] == "remove"
    copies = [texts[0]] * 4 + texts[4:]
    assert pii.disclosing(docs(spark, copies), gain=3.0).count() == 0


def test_any_number_of_zeros_is_an_address_part():
    zeros = "0" * 5000
    assert pii.entities(f"{zeros}.1.1.1") == [(1, 0, 5006)]
    assert pii.entities(f"{zeros}256.1.1.1") == [] and pii.entities(f"1.{zeros}255.0.0") == [(1, 0, 5009)]


def test_sanitising_keeps_columns_of_any_name(spark):
    d = docs(spark, ["mail a@b.cc", None, ""]).selectExpr("*", "1 as _key", "'t' as _of", "2 as _spans", "3 as _t", "4 as _text", "5 as key", "6 as row", "7 as spans", "8 as `a.b`")
    out = pii.sanitise(d)
    assert out.columns == d.columns
    assert {(r.doc_id, r.text, r["_key"], r.row, r["a.b"]) for r in out.collect()} == {(0, "mail [EMAIL]", 1, 6, 8), (1, None, 1, 6, 8), (2, "", 1, 6, 8)}


def test_a_list_of_addresses_takes_seconds(spark):
    import time

    text = " ".join(f"Mr Smith{i % 50} <user{i}@example{i % 97}.org>," for i in range(60_000))
    began = time.perf_counter()
    found = {r.doc_id: r.spans for r in pii.find(docs(spark, [text, "plain text"])).collect()}
    assert time.perf_counter() - began < 60
    assert sum(s.kind == "email" for s in found[0]) == 60_000 and found[1] == []


def test_cover():
    r = random.Random(1)
    for _ in range(300):
        spans = [(0, a, a + r.randint(1, 6)) for a in (r.randrange(40) for _ in range(r.randint(0, 8)))]
        cover = pii.Cover(spans)
        for a in range(44):
            for b in range(a + 1, 46):
                assert cover.meets(a, b) == any(s < b and a < e for _, s, e in spans)
