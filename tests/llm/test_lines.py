import numpy as np
import pytest
from pyspark.sql import functions as F

from heddle.llm import lines as L
from heddle.llm.components import local_roots

MIN_WORDS = 3
KIND = "doc_id long, text string, line string, digest string, n_removed string"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(rows):
    """{(id, text): line numbers lost} over all pairs of lines."""
    seen = []
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            line = L.normal(line)
            if len(line.split()) >= MIN_WORDS:
                seen.append((i is None, i or 0, t, n, line))
    lines = sorted({s[4] for s in seen})
    sim = [int(x) for x in L.simhashes(lines)]
    pairs = [(x, y) for x in range(len(lines)) for y in range(x) if (sim[x] ^ sim[y]).bit_count() <= 3 and levenshtein(lines[x], lines[y]) <= 0.2 * max(len(lines[x]), len(lines[y])) + 1e-9]
    root = dict(zip(lines, local_roots(len(lines), *np.array(pairs or np.empty((0, 2)), dtype=int).reshape(-1, 2).T)))
    return seen, root


def test_edit_distance():
    rng = np.random.default_rng(8)
    for _ in range(300):
        a = "".join(rng.choice(list("abc"), rng.integers(0, 30)))
        b = list(a)
        for _ in range(rng.integers(0, 6)):
            if b and rng.random() < 0.5:
                del b[rng.integers(len(b))]
            else:
                b.insert(rng.integers(len(b) + 1), str(rng.choice(list("abcd"))))
        b = "".join(b)
        want = levenshtein(a, b)
        for most in (0, 2, 5, 100):
            got = L.edit_distance(a, b, most)
            assert got == want if want <= most else got > most
    long = "x" * 5000 + "y" + "z" * 5000
    assert L.edit_distance(long, long.replace("y", "qq"), 10) == 2


def test_distances_in_step():
    rng = np.random.default_rng(17)
    a = ["".join(rng.choice(list("abcdeé\U0001f600"), rng.integers(0, 200))) for _ in range(150)] + ["", "", "x"]
    b = ["".join(c for c in x if rng.random() > 0.2) + "".join(rng.choice(list("abc"), rng.integers(0, 30))) for x in a[:-3]] + ["", "yz", ""]
    want = [levenshtein(x, y) for x, y in zip(a, b)]
    assert L.edit_distances(a, b).tolist() == want and L.edit_distances(b, a).tolist() == want and L.edit_distances([], []).tolist() == []
    good = L.similar_lines(a, b)
    assert good.tolist() == [d <= int(0.2 * max(len(x), len(y)) + 1e-9) for d, x, y in zip(want, a, b)] and 5 < good.sum() < 150


def test_simhash_of_lines():
    import xxhash

    lines = ["a b c", "one", "", "a a a b", "a | b | c |", "| |", " ".join(f"x{i}" for i in range(700))] + ["w%d v" % i for i in range(9)]
    for line, got in zip(lines, L.simhashes(lines)):
        h = [xxhash.xxh64_intdigest(w.encode(), 1) for w in set(line.split()) if w != "|"]
        assert int(got) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("piece", [512, 4])
def test_keeps_first_of_each_group(spark, piece):
    rng = np.random.default_rng(9)
    words = [f"word{i}" for i in range(80)]
    bases = [" ".join(rng.choice(words, rng.integers(40, 90))) for _ in range(12)]
    rows = []
    for d in range(60):
        text = []
        for _ in range(rng.integers(0, 6)):
            w = bases[rng.integers(len(bases))].split()
            for _ in range(rng.integers(0, 3)):
                w[rng.integers(len(w))] += "x"
            text.append(("  ".join(w)).upper() if rng.random() < 0.2 else " ".join(w))
            if rng.random() < 0.3:
                text.append("")
        rows.append((d, "\n".join(text)))
    rows += [(100, None), (101, ""), (None, bases[0] + "\nnew line stays here"), (102, "two words\ntwo words")]
    df = spark.createDataFrame([(i, t, "x", "y", None) for i, t in rows], KIND)
    got = {(r.id, n) for r in L.repeated_lines(df, radius=3, min_words=3, piece=piece).collect() for n in r.lines}
    seen, root = brute(rows)
    groups = {}
    for last, i, t, n, line in seen:
        groups.setdefault(root[line], []).append((last, i, n))
    assert got == {((None if last else i), n) for g in groups.values() for last, i, n in sorted(g)[1:]} and len(got) > 50
    assert any(len({x[4] for x in seen if root[x[4]] == g}) > 1 for g in groups)
    out = {r.doc_id: r for r in L.without_lines(df, L.repeated_lines(df, radius=3, min_words=3)).collect()}
    assert len(out) == len(rows) and set(df.columns) <= set(out[0].asDict())
    for i, t in rows:
        want = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in got)
        assert out[i].text == want and out[i].n_removed == sum(x[0] == i for x in got)


def test_repeated_rows_count_once_and_empty(spark):
    line = "this very line comes twice"
    df = spark.createDataFrame([(1, line, "", "", ""), (1, line, "", "", ""), (2, line, "", "", "")], KIND)
    assert [(r.id, r.lines) for r in L.repeated_lines(df).collect()] == [(2, [0])]
    empty = df.limit(0)
    assert L.repeated_lines(empty).collect() == [] and L.without_lines(empty, L.repeated_lines(empty)).collect() == []


def test_bitmap_holds_every_digest(spark):
    digests = [0, -1, 5, 1 << 40, -(1 << 50) + 77, 32767, 32768, (1 << 24) - 1]
    bits = L._bitmap(spark.createDataFrame([(d,) for d in digests], "digest long"))
    want = {d % (1 << 64) % L.BITMAP for d in digests}
    assert {i for i in range(L.BITMAP) if bits[i >> 3] >> (i & 7) & 1} == want


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    out = L.op10_fuzzy_lines(spark, sf).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy(F.col("doc_id")).collect()]
    assert sorted(r.doc_id for r in out) == [i for i, _ in docs]
    texts = dict(docs)
    left = [L.normal(x) for r in out for x in (r.text or "").split("\n")]
    long = [x for x in left if len(x.split()) >= MIN_WORDS]
    assert len(long) == len(set(long)) and {L.normal(x) for t in texts.values() for x in t.split("\n") if len(x.split()) >= 3} >= set(long)
    assert all(r.n_lines == len(texts[r.doc_id].split("\n")) for r in out)


def found(lines, pairs):
    """Whether each pair of lines shares a key under which it is compared."""
    line, key, maps = L.keys_of(lines)
    own = [set() for _ in lines]
    for n, k in zip(line.tolist(), key.tolist()):
        own[n].add(k)
    out = []
    for a, b in pairs:
        kinds = np.array(sorted({k & 3 for k in own[a] & own[b]}), np.int64)
        most = np.full(len(kinds), int(0.2 * max(len(lines[a]), len(lines[b])) + 1e-9))
        halves = [tuple(np.array([maps[n, k, h] for k in kinds], np.uint64) for n in (a, b)) for h in (0, 1)]
        out.append(bool(len(kinds)) and bool(L.comparable(kinds, halves, most).any()))
    return np.array(out)


def test_words_passed_over_bound_the_distance():
    rng = np.random.default_rng(15)
    accepted = 0
    for _ in range(500):
        x = [str(w) for w in rng.choice(list("abcde") + ["longer", "other"], rng.integers(1, 14))]
        y = list(x)
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(len(y) + 1))
            if rng.random() < 0.5:
                y[at : at + 1] = []
            else:
                y.insert(at, str(rng.choice(["new", "a", "longer"])))
        a, b = " ".join(x), " ".join(y)
        for most in (0, 2, 5, 9):
            if L.aligned(x, y, most):
                accepted += 1
                assert levenshtein(a, b) <= most
    assert accepted > 300


def test_bigram_bitmaps_lose_no_pair():
    rng = np.random.default_rng(16)
    for _ in range(300):
        a = "".join(rng.choice(list("abcdef "), rng.integers(8, 76)))
        b = list(a)
        for _ in range(int(0.2 * len(a))):
            at = int(rng.integers(len(b)))
            b[at : at + 1] = [[], ["x"], ["a", "b"]][rng.integers(3)]
        b = "".join(b)
        d = levenshtein(a, b)
        if len(b) >= 2:
            m = L.bigrams([a, b])
            assert L.comparable(np.array([L.SHORT_KIND]), [(m[:1, h], m[1:, h]) for h in (0, 1)], np.array([d]))[0]


def test_recall_against_all_similar_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = sorted({x for r in docs.collect() for x in map(L.normal, r.text.split("\n")) if x})
    pairs = [(a, b) for a in range(len(lines)) for b in range(a) if abs(len(lines[a]) - len(lines[b])) <= 0.2 * max(len(lines[a]), len(lines[b])) and L.similar(lines[a], lines[b])]
    print(f"{len(lines)} lines, {len(pairs)} pairs, recall {found(lines, pairs).mean():.3f}")
    assert len(pairs) > 20 and found(lines, pairs).mean() >= 0.95


@pytest.mark.parametrize("edit", ["character", "word", "words", "scattered"])
@pytest.mark.parametrize("length", [5, 9, 12, 20, 35, 50, 70, 100, 400])
def test_recall_by_length(length, edit):
    """Lines and their edits, all of similarity 0.8 or more by the plain distance."""
    rng = np.random.default_rng(length)
    letters = list("etaoinshrdlu")
    lines, pairs = [], []
    for _ in range(400 if length < 100 else 60):
        a = ""
        while len(a) < length:
            a += "".join(rng.choice(letters, rng.integers(2, 9))) + " "
        a = L.normal(a[:length].replace(" ", "e", 1) if a[length - 1] == " " else a[:length])
        most, b = int(0.2 * len(a) + 1e-9), list(a)
        if edit.startswith("word"):  # of six characters; "words" are a tenth of the line
            for _ in range(max(1, len(b) // 60) if edit == "words" else 1):
                at = int(rng.integers(len(b)))
                for i in range(at, min(len(b), at + min(most, 6))):
                    b[i] = str(rng.choice(letters))
        else:
            for _ in range(1 if edit == "character" else most):
                b[rng.integers(len(b))] = str(rng.choice(letters))
        b = L.normal("".join(b))
        if a != b and levenshtein(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
            pairs.append((len(lines), len(lines) + 1))
            lines += [a, b]
    share = found(lines, pairs).mean()
    print(length, edit, len(pairs), f"{share:.3f}")
    # single characters changed all over a long line leave no gram whole: the README has the figures
    assert len(pairs) > 30 and (share >= 0.9 or edit == "scattered" and (length >= 50 or share >= 0.85))


def test_lines_with_a_changed_word_go_whatever_their_simhash(spark):
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(3, 8))) for _ in range(500)]
    rows = []
    for d in range(40):
        w = rng.choice(words, rng.integers(12, 30)).tolist()
        rows.append((2 * d, " ".join(w)))
        w[rng.integers(len(w))] = "other"
        rows.append((2 * d + 1, " ".join(w)))
    df = spark.createDataFrame([(i, t, "", "", "") for i, t in rows], KIND)
    assert sorted(r.id for r in L.repeated_lines(df).collect()) == [2 * d + 1 for d in range(40)]
    assert L.repeated_lines(df, radius=3).count() < 20


def test_query_takes_repeats_of_short_lines_out(spark, tmp_path):
    rows = [(1, "one two\n\nword\n日本語"), (2, "Word\n日本語\n\nnew here\none  two")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'en' lang", "'s' source", "length(text) n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.text, r.n_removed) for r in L.op10_fuzzy_lines(spark, str(tmp_path)).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("\nnew here", 3)}


def test_very_long_lines_and_clashing_columns(spark):
    rng = np.random.default_rng(13)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(3000)]
    long = " ".join(rng.choice(words, 30_000))
    rows = [(1, long), (2, long.replace(" ", "  ") + "\nown"), (3, long[:-6] + "edited")]
    df = spark.createDataFrame([(i, t, "a", "b", "c", "d", 7) for i, t in rows], "doc_id long, text string, of string, text_hash string, lines string, id string, _of long")
    out = {r.doc_id: r for r in L.without_lines(df, L.repeated_lines(df)).collect()}
    assert {i: (r.text, r.n_removed) for i, r in out.items()} == {1: (long, 0), 2: ("own", 1), 3: ("", 1)}
    assert tuple(out[2])[2:7] == ("a", "b", "c", "d", 7)


def test_bigrams_that_are_counted_tell_short_lines_of_few_letters_apart():
    rng = np.random.default_rng(21)
    lines = ["".join(rng.choice(list("then aod"), 36)) for _ in range(200)]
    maps = L.keys_of(lines)[2]
    a, b = np.triu_indices(len(lines), 1)
    for kind in (L.SHORT_KIND, L.MIDDLE_KIND):
        of = maps[:, kind] if kind == L.SHORT_KIND else np.concatenate([np.zeros((len(lines), 2), np.uint64), maps[:, kind, 2:]], axis=1)  # all bins agree
        assert L.comparable(np.full(len(a), kind), [(of[a, h], of[b, h]) for h in range(of.shape[1])], np.full(len(a), 7)).mean() < 0.1


def test_pair_that_shares_keys_of_two_kinds_is_verified_under_either():
    import pyarrow as pa

    t = ["x" * 70, "x" * 69 + "y"]
    keys = [[8 | L.LONG_KIND, 16 | L.MIDDLE_KIND]] * 2  # under the first one too few bins agree
    columns = {"key": [16 | L.MIDDLE_KIND] * 2, "one": [0, 0], "two": [0, 0], "role": [0, 0], "digest": [1, 2], "chars": [70, 70], **{m: [0, 0] for m in L.MAPS}, "sim": [0, 0], "label": [1, 2], "keys": keys, "t": t}
    got = L._verified(0.8, None, L.similar_lines)(pa.table(columns))
    assert sorted(map(sorted, zip(got.column("a").to_pylist(), got.column("b").to_pylist()))) == [[1, 2]]
