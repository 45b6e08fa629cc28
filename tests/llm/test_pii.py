import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from heddle.llm import pii as P

KIND = "doc_id long, text string, spans string, digest string"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern.replace("[\\x20-]?", "[ -]?"), text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and not all(int(x) <= 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def run(spark, texts):
    df = spark.createDataFrame([(i, t, "x", None) for i, t in texts], KIND)
    return P.personal_data(df).select("id", "spans").collect()


def base_of(row):
    return [tuple(s) for s in row.spans if s.kind != "term"]


CASES = [
    None, "", "a@b.c", "x a@b.c_d@e.f.g y", "a@b-c.d_e@f.g", "a@@b.c a@b a@b. .@x.y", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.03.4", "1.2.3 4.5.6.7",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 4", "+1 (555) 010-9999 +12 +1234567", "é\U0001f600 mail é@x.fr \U0001f600 a@x.fr +49 30 1234567-", "+1+2+3 4567 8901",
    "1" * 50 + " 4" + "0" * 16, "a.b.c%d+e-f@G-H.I.J.K-", "x@1.2.3.4 5.6.7.8@y.z", "00000000000000000000000001.1.1.1 9999999999999999999.1.1.1",
]


def test_base_spans(spark):
    for row in run(spark, list(enumerate(CASES))):
        assert base_of(row) == plain_spans(CASES[row.id]), CASES[row.id]


def test_very_long_texts(spark):
    texts = ["a" * 300_000, "1" * 300_000, "1 " * 150_000, "1." * 20_000, "+1" + "(" * 200_000, "a@b" + ".c" * 100_000, "q a@b.c" * 500]
    want = {0: 0, 1: 0, 2: 0, 3: 5_000, 4: 0, 5: 1, 6: 500}
    assert {row.id: len(base_of(row)) for row in run(spark, list(enumerate(texts)))} == want


def corpus():
    texts = []
    for i in range(8):
        texts.append(f"the quick note {i} from zorblax about jane@corp.example and more words number{i} here")
    texts += [f"the quick note about nothing and more words from here {i}" for i in range(300)]
    texts += ["Zorblax came alone", "mail jane@corp.example", "ZORBLAX zorblaxes", texts[0], None]
    return texts




def test_disclosing_terms(spark):
    texts = corpus()
    letters = lambda t: re.findall(r"[^\W\d_]+", t or "")
    terms = {w for w in {x.lower() for t in texts for x in letters(t)} if w == "zorblax"}
    got = {r.id: [(s.start, s.end) for s in r.spans if s.kind == "term"] for r in run(spark, list(enumerate(texts)))}
    for i, t in enumerate(texts):
        assert got[i] == [m.span() for m in re.finditer(r"[^\W\d_]+", t or "") if m[0].lower() in terms], t
    assert sum(map(len, got.values())) == 11


def test_term_inside_a_base_span_is_left(spark):
    texts = [f"zed says zorblax {i} jane@corp.example" for i in range(4)] + ["see zorblax@corp.example"] + [f"other {i}" for i in range(200)]
    rows = {r.id: r.spans for r in run(spark, list(enumerate(texts)))}
    assert [s.kind for s in rows[4]] == ["email"] and "term" in {s.kind for s in rows[0]}


def test_sanitised(spark):
    df = spark.createDataFrame([(0, "call +1 555 010 9999 or a@b.c now", "", ""), (1, None, "", ""), (2, "é\U0001f600 1.2.3.4", "", "")], KIND)
    rows = P.personal_data(df).withColumnRenamed("spans", "s").join(df.select("doc_id", "text"), F.col("id") == F.col("doc_id"))
    out = {r.id: r.x for r in rows.select("id", P.sanitised(F.col("text"), F.col("s")).alias("x")).collect()}
    assert out == {0: "call [PHONE] or [EMAIL] now", 1: None, 2: "é\U0001f600 [IP]"}


def test_repeats_null_ids_empty(spark):
    rows = run(spark, [(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c")])
    assert sorted(str(r.id) for r in rows) == ["1", "1", "None"] and all(base_of(r) == [("email", 0, 5)] for r in rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()}
    df = P.op5_pii_disclosure(spark, f"/root/testdata/{sf}")
    out = df.collect()
    assert len(out) == len(docs)
    for r in out:
        want = plain_spans(docs[r.doc_id])
        n = Counter(k for k, *_ in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (n["email"], n["ip"], n["card"], n["phone"])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and r.spans.startswith(text)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def terms_of(spark, texts):
    return {r.id: [texts[r.id][s.start : s.end] for s in r.spans if s.kind == "term"] for r in run(spark, list(enumerate(texts)))}


def test_entity_of_one_text(spark):
    texts = ["the plain words of all and zorblax for jane@corp.example"] + ["the plain words of all and for this"] * 2 + [f"the plain words of all and for {i}" for i in range(3000)]
    got = terms_of(spark, texts)
    assert got[0] == ["zorblax"] and not any(got[i] for i in got if i)


def test_pairs_count_over_whole_texts(spark):
    far = "the plain words of all and for this " * 10
    texts = [f"zorblax {far} jane@corp.example {i}" for i in range(4)] + [f"zorblax jane@corp.example {i}" for i in range(4)] + [f"{far} {i}" for i in range(300)]
    got = terms_of(spark, texts)
    assert all(got[i] == (["zorblax"] if i < 8 else []) for i in got)


def brute_terms(texts):
    """Terms that disclose an entity, by the definition, from all pairs of entity and term."""
    distinct = sorted({t or "" for t in texts})
    n = len(distinct)
    words = [{w.lower() for w in re.findall(r"[^\W\d_]+", t)} for t in distinct]
    n_term = Counter(w for ws in words for w in ws)
    held = [{f"{k}:{t[a:b].lower()}" for k, a, b in plain_spans(t)} for t in distinct]
    n_entity = Counter(e for es in held for e in es)
    pairs = Counter()
    for t, es in zip(distinct, held):
        own = {w.lower() for w in re.findall(r"[^\W\d_]+", re.sub(r"\S*[@0-9]\S*", " ", t)) if len(w) > 2}
        pairs.update((e, w) for e in es for w in own)
    score = lambda e, w, k: 1 + math.log2((k + n_entity[e] / n) / (n_term[w] + 1)) / math.log2(n / n_entity[e])
    return {w for (e, w), k in pairs.items() if n_entity[e] < n and score(e, w, k) >= 0.9}


def test_disclosure_matches_brute_force(spark):
    rng = np.random.default_rng(14)
    words = [f"{a}{b}{c}o" for a in "bcdfgh" for b in "aei" for c in "klmnprst"]
    weight = 1 / np.arange(1, len(words) + 1)
    people = [("karlo", "karlo@corp.example"), ("mirna", "+49 30 1234 567"), ("tosca", "10.1.2.3"), ("velma", "velma@a.b")]
    texts = []
    for _ in range(400):
        own = rng.choice(words, rng.integers(3, 25), p=weight / weight.sum()).tolist()
        for name, mark in people:
            if rng.random() < 0.03:
                own.insert(int(rng.integers(len(own))), mark)
                if rng.random() < 0.9:
                    own.insert(int(rng.integers(len(own))), name.title())
        texts.append(" ".join(own))
    texts += texts[:40] + ["Karlo was here", None, ""]
    want = brute_terms(texts)
    assert {"karlo", "mirna"} & want
    for i, found in terms_of(spark, texts).items():
        t = texts[i] or ""
        base = [(a, b) for _, a, b in plain_spans(t)]
        spans = [m.span() for m in re.finditer(r"[^\W\d_]+", t) if m[0].lower() in want]
        assert found == [t[a:b] for a, b in spans if not any(x < b and a < y for x, y in base)], t


def test_terms_in_very_long_texts(spark):
    rng = np.random.default_rng(19)
    words = ["".join(rng.choice(list("abcdefgh"), 7)) for _ in range(12_000)]
    long = " ".join(words) + " jane@corp.example " + "x" * 20_000 + ", " + " ".join(words[::-1]) + "y" * 9_000
    texts = [long, *(" ".join(words[i::40]) + f" other{i}" for i in range(40) if i % 4)] + [f"more {i}" for i in range(2000)]
    want = brute_terms(texts)
    assert len(want) > 2000
    spans = [m.span() for m in re.finditer(r"[^\W\d_]+", long) if m[0].lower() in want]
    got = {r.id: [(s.start, s.end) for s in r.spans if s.kind == "term"] for r in run(spark, list(enumerate(texts)))}
    at = long.index("jane")
    assert got[0] == [(a, b) for a, b in spans if not (a < at + 17 and at < b)]
