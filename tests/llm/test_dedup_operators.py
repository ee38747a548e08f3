import hashlib
import random
import re
from collections import Counter
from itertools import combinations, pairwise

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quillstone.llm import components, exact, line_dedup, minhash, passages, queries

DOCS = "/root/testdata/sf0.001/documents.parquet"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return (text or "").encode().split()


def shingle_set(text, size):
    w = words((text or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def groups(nodes, linked):
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(nodes, 2):
        if linked(a, b):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def texts_with_copies(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 90))] for _ in range(n)]
    rows = [" ".join(b) for b in base]
    for _ in range(2 * n):
        b = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            if b:
                b[rng.randrange(len(b))] = rng.choice(vocabulary)
        rows.append(" ".join(b) if rng.random() < 0.7 else "  ".join(b).upper())
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_minhash_matches_brute_force(spark, size):
    rows = texts_with_copies() + ["", None, "one two", "ONE two", "one two three"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sets = {i: shingle_set(t, size) for i, t in enumerate(rows)}
    want = groups(list(sets), lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = {r.doc_id: r for r in minhash.near_duplicates(df, size).collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    assert all(r.kept == (k == r.component_id) for k, r in got.items())
    assert sorted(r.doc_id for r in minhash.keep_one(df, size).collect()) == sorted(set(want.values()))


@pytest.mark.parametrize("seed", [1, 2])
def test_minhash_among_near_copies_of_one_text(spark, seed):
    """Copies with changes of their own, too far from each other for one pivot, and copies of such copies."""
    rng = random.Random(seed)
    change = lambda text, n: [f"c{rng.randrange(10**6)}" if k in places else w for places in [set(rng.sample(range(len(text)), n))] for k, w in enumerate(text)]
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = [change(base, rng.randint(1, 9)) for _ in range(60)]
    rows += [change(rng.choice(rows), rng.randint(1, 4)) for _ in range(40)]
    rows = [" ".join(r) for r in rows] + [" ".join(base)] * (seed - 1)
    rng.shuffle(rows)
    sets = {i: shingle_set(t, 4) for i, t in enumerate(rows)}
    want = groups(list(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    assert 5 < len(set(want.values())) < len(rows)
    calls = []
    real = minhash._links_of_differences
    minhash._links_of_differences = lambda found, percent: calls.append(found.count()) or real(found, percent)
    try:
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"), 4).collect()}
    finally:
        minhash._links_of_differences = real
    assert got == want and calls[0] > 20


def test_links_of_differences_are_all_and_only_the_links(spark):
    """Against all pairs, with members of few and of many changes, larger and smaller ones, and components beside the pivot's."""
    rng = random.Random(4)
    pivot = set(range(100))
    members = {}
    for i in range(1, 121):
        x = set(rng.choice(list(members.values())) if members and rng.random() < 0.5 else pivot)
        x -= set(rng.sample(sorted(x), rng.randint(0, 12)))
        x |= {rng.randrange(100, 400) for _ in range(rng.randint(0, 14))}
        members[i] = x
    linked = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    label = {i: 0 if linked(x, pivot) else rng.choice([i, 7, 9]) for i, x in members.items()}
    rows = [(i, 0, label[i], label[i] == 0, len(x), 100, len(x & pivot), sorted(x ^ pivot)) for i, x in members.items()]
    found = spark.createDataFrame(rows, "id long, pivot long, label long, main boolean, n long, pivot_n long, common long, tokens array<long>")
    got = {tuple(sorted(r)) for r in minhash._links_of_differences(found, 80).collect()}
    want = {(i, j) for i, j in combinations(members, 2) if label[i] != label[j] and linked(members[i], members[j])}
    assert got == want and len(want) > 20


def test_minhash_on_the_documents(spark):
    rows = pq.read_table(DOCS, columns=["doc_id", "text"]).to_pylist()
    sets = {r["doc_id"]: shingle_set(r["text"], 5) for r in rows}
    want = groups(list(sets), lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.read.parquet(DOCS)).collect()}
    assert got == want


def test_minhash_refuses_what_its_bands_would_miss(no_documents):
    for find in (minhash.near_duplicates, minhash.keep_one):
        with pytest.raises(ValueError, match="percent"):
            find(no_documents, percent=79)


def test_superminhash_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 1 << 62, n, dtype=np.uint64) for n in (300, 50, 50))
    x, y = minhash.signatures([np.unique(np.r_[both, a]), np.unique(np.r_[both, b])])
    assert abs((x == y).mean() - 0.75) < 0.15
    single = minhash.signatures([both[:1]])
    assert len(np.unique(single >> np.uint64(56))) == minhash.PLACES  # one element fills every place, each with another j


@pytest.mark.parametrize("held", [components.HELD, 10])
def test_components_of_chains_and_hubs(spark, monkeypatch, held):
    monkeypatch.setattr(components, "HELD", held)
    chain = [(i, i + 1) for i in range(200, 260)]
    hub = [(1, i) for i in range(2, 100)]
    df = spark.createDataFrame([*chain, *hub, (5, 5), (99, 1)], "a long, b long")
    got = {r.node: r.label for r in components.components(df).collect()}
    assert got == {**{i: 200 for i in range(200, 261)}, **{i: 1 for i in range(1, 100)}}
    assert components.components(df.limit(0)).count() == 0


def brute_exact(rows):
    by = {}
    for doc, text in rows:
        by.setdefault(re.sub("[\x20\x09-\x0d]", "", text or ""), []).append((doc, text or ""))
    out = []
    for plain, members in by.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(plain.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=str)


def test_exact_matches_brute_force(spark, odd_documents, no_documents, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts_with_copies() + ["ab", "abc", "a bc", "abcd", "b", "", " ", None])]
    for held in (exact.HELD_BYTES, 200):
        monkeypatch.setattr(exact, "HELD_BYTES", held)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert sorted(map(tuple, exact.exact_duplicates(df).collect()), key=str) == brute_exact(rows)
    odd = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert sorted(map(tuple, exact.exact_duplicates(odd_documents).collect()), key=str) == brute_exact(odd)
    assert exact.exact_duplicates(no_documents).count() == 0


def test_trie_holds_and_spills_in_order():
    rng = random.Random(2)
    keys = sorted({bytes(rng.choices(b"abc", k=rng.randint(0, 6))) for _ in range(300)})
    trie = exact.Trie()
    for k in rng.sample(keys, len(keys)):
        trie.insert(k).value = k
    assert list(exact.Trie.values(trie.root)) == keys
    trie, seen = exact.Trie(), []
    for a, _ in pairwise([*keys, b"\xff"]):
        seen += trie.spill_before(a)
        trie.insert(a).value = a
    assert sorted([*seen, *exact.Trie.values(trie.root)]) == keys
    assert len(seen) > len(keys) // 2


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edits_are_the_levenshtein_distance():
    rng = random.Random(9)
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 90)))
        b = list(a) if rng.random() < 0.7 else [rng.choice("abc") for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 6)):
            b.insert(rng.randint(0, len(b)), "z") if rng.random() < 0.5 or not b else b.pop(rng.randrange(len(b)))
        b = "".join(b)
        want = distance(a, b)
        assert line_dedup.edits(a, b, 200) == want
        assert (line_dedup.edits(a, b, 5) is not None) == (want <= 5)


def test_similar_all_is_similar_of_each_pair(monkeypatch):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdeé𝔸") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    pairs = []
    for _ in range(300):
        a = [rng.choice(vocabulary) for _ in range(rng.randint(1, 45))]
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 2)):
            at = rng.randrange(len(b))
            b[at : at + 1] = rng.choice([[rng.choice(vocabulary)], [b[at], rng.choice(vocabulary)]])
        pairs.append((" ".join(a), " ".join(b)))
    pairs += [("", ""), ("a", ""), ("a" * 64, "a" * 63 + "b"), ("a" * 65, "b" * 65), ("a" * 128, "a" * 129), ("ab" * 600, "ab" * 590), ("ab" * 600, "ba" * 300)]
    want = [distance(a, b) <= int((1 - line_dedup.SIMILARITY) * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    xs, ys = [list(x) for x in zip(*pairs, strict=True)]
    assert line_dedup.similar_all(xs, ys).tolist() == want and 50 < sum(want) < len(want) - 50
    monkeypatch.setattr(line_dedup, "WIDE", 100)
    monkeypatch.setattr(line_dedup, "TOGETHER", 16)
    assert line_dedup.similar_all(xs, ys).tolist() == want == [line_dedup.similar(a, b) for a, b in pairs]
    assert line_dedup.similar_all([], []).tolist() == []


def brute_lines(rows):
    """rows of (doc, text) in order of doc: the kept text and the number of lines removed."""
    found = [(d, k, line_dedup.normalise(x)) for d, t in rows for k, x in enumerate((t or "").split("\n"))]
    found = [f for f in found if f[2]]
    distinct = sorted({f[2] for f in found})
    sims = {x: line_dedup.simhash(x) for x in distinct}

    def linked(a, b):
        return (sims[a] ^ sims[b]).bit_count() <= line_dedup.DISTANCE and distance(a, b) <= (1 - line_dedup.SIMILARITY) * max(len(a), len(b)) + 1e-9

    label = groups(distinct, linked)
    first = {}
    for d, k, x in found:
        first[label[x]] = min(first.get(label[x], (d, k)), (d, k))
    gone = {(d, k) for d, k, x in found if first[label[x]] != (d, k)}
    return {d: (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone), sum(g[0] == d for g in gone)) for d, t in rows}


def test_lines_match_brute_force(spark, no_documents):
    rng = random.Random(4)
    lines = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eta", "theta", "iota", "kappa"]) + str(rng.randint(0, 30)) for _ in range(rng.randint(3, 60))) for _ in range(40)]

    def vary(line):
        w = line.split(" ")
        if rng.random() < 0.6:
            w[rng.randrange(len(w))] += "x"
        return " ".join(w) if rng.random() < 0.5 else " ".join(w).upper() + "!"

    rows = [(i, "\n".join(vary(rng.choice(lines)) for _ in range(rng.randint(0, 8)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "\n \n---"), (63, "same 1\nSAME 2\nother"), (64, "same 3"), (65, "é è\nÉ")]
    df = spark.createDataFrame([(*r, "kept", 1) for r in rows], "doc_id long, text string, first string, again int").repartition(3)
    got = {r.doc_id: (r.text, r["__n_removed"]) for r in line_dedup.dedup_lines(df).collect()}
    assert got == brute_lines(rows)
    assert sum(n for _, n in got.values()) > 50
    assert set(line_dedup.dedup_lines(df).columns) >= {"doc_id", "text", "first", "again"}
    assert line_dedup.dedup_lines(no_documents).count() == 0


def test_similar_lines_go_whatever_their_simhashes(spark, tmp_path):
    """The query's links against brute force by edit similarity alone."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rows = []
    for i in range(40):
        line = [rng.choice(vocabulary) for _ in range(5 + 2 * i)]
        rows.append((len(rows), " ".join(line)))
        for _ in range(3):
            w, at = list(line), rng.randrange(len(line))
            w[at : at + 1] = rng.choice([[rng.choice(vocabulary)], [w[at], rng.choice(vocabulary)], []])
            rows.append((len(rows), " ".join(w)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    left = {r.doc_id for r in queries.op5_line_dedup(spark, str(tmp_path)).collect() if r.n_removed == 0}
    text = dict(rows)
    close = lambda a, b: line_dedup.edits(text[a], text[b], int((1 - line_dedup.SIMILARITY) * max(len(text[a]), len(text[b])) + 1e-9)) is not None
    label = groups(list(text), close)
    assert left == set(label.values())
    far = [(a, b) for a, b in combinations(text, 2) if (line_dedup.simhash(text[a]) ^ line_dedup.simhash(text[b])).bit_count() > line_dedup.DISTANCE and close(a, b)]
    assert len(far) > 50


def test_lines_with_a_common_passage_make_pairs_only_where_edits_can_reach(spark, tmp_path, monkeypatch):
    """Tails of other letters after one passage: such lines are left open by their pivots, and none of their pairs is made; what is similar still goes."""
    rng = random.Random(31)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(3, 8)))
    passage = " ".join(word("abcdefgh") for _ in range(30))
    letters, rows = "ijklmnopqrstuvwxyz", []
    for i in range(24):
        tail = [word(letters[i % 17] + letters[(i * 5 + i // 17 + 1) % 17]) for _ in range(22)]
        rows.append(f"{passage} {' '.join(tail)}")
        if i % 4 == 0:
            tail[3], tail[17] = word(letters), word(letters)
            rows.append(f"{passage} {' '.join(tail)} é 1")
    rows = list(enumerate(rows))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    kept, made = line_dedup.table, {}

    def counted(df, name):
        out = kept(df, name)
        made[name] = out[0].count()
        return out

    monkeypatch.setattr(line_dedup, "table", counted)
    left = {r.doc_id for r in queries.op5_line_dedup(spark, str(tmp_path)).collect() if r.n_removed == 0}
    text = {i: line_dedup.normalise(x) for i, x in rows}
    label = groups(list(text), lambda a, b: line_dedup.similar(text[a], text[b]))
    assert left == set(label.values()) and len(left) == 24
    assert made["open"] > 100 and made["rest"] < 40


def test_letters_part_no_similar_lines(spark):
    rng = random.Random(32)
    rows = []
    for _ in range(400):
        letters = "".join(rng.sample("abcdefghijklmnopqrstuvwxyzéßя0", rng.choice([2, 9, 30])))
        a = [rng.choice(letters + " ") for _ in range(rng.choice([3, 40, 300, 900]))]
        b = list(a)
        for _ in range(rng.randint(0, max(2, len(a) // 3))):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters), rng.choice("xyz é")])
        rows.append((line_dedup.normalise("".join(a)), line_dedup.normalise("".join(b))))
    rows = [r for r in rows if all(r)]
    columns = []
    for side in zip(*rows, strict=True):
        x = line_dedup.Lines(pa.array(side))
        assert len(x.chars) == len(rows)
        columns += [x.chars.tolist(), *(c.to_pylist() for c in x.letters())]
    names = [f"{c}_{side}" for side in "ab" for c in ("chars", *line_dedup._LETTERS)]
    df = spark.createDataFrame(list(zip(*columns, strict=True)), ", ".join(f"{n} {'int' if n.startswith('chars') else 'long'}" for n in names)).coalesce(1)
    got = [r.ok for r in df.select(line_dedup._close_by_letters().alias("ok")).collect()]

    def want(a, b):
        x, y = (Counter("other" if c in "0éßя" else c for c in t) for t in (a, b))
        apart = 0
        for some in ("abcdefg", "hijklmn", "opqrstu", ["v", "w", "x", "y", "z", " ", "other"]):
            apart += sum(abs(min(x[c], line_dedup.MANY) - min(y[c], line_dedup.MANY)) for c in some) % 255
        return apart + abs(len(a) - len(b)) <= 2 * int((1 - line_dedup.SIMILARITY) * max(len(a), len(b)) + 1e-9)

    assert got == [want(*r) for r in rows]
    similar = [line_dedup.similar(*r) for r in rows]
    assert all(g for g, s in zip(got, similar, strict=True) if s) and 50 < sum(similar) < sum(got) < len(rows)


def test_a_pair_is_made_in_the_first_bucket_by_words(spark):
    rng = random.Random(33)
    names = line_dedup._KEYS
    rows = [(i, rng.getrandbits(2) << 40, *(rng.choice([None, None, 1, 2, -2, -5, 7, 8, 9]) for _ in names)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, sim long, " + ", ".join(f"{c} int" for c in names)).coalesce(1)
    keys = [*(line_dedup._word_key(i) for i in range(len(names))), *line_dedup._block_keys(F.col("sim"), 5)]
    x, y = line_dedup._sides(df.select(F.explode(F.array(*keys)).alias("bucket"), "id", *line_dedup._packed(names)).where("bucket is not null"))
    pairs = x.join(y, "bucket").where((F.col("id_a") < F.col("id_b")) & line_dedup._no_earlier(len(names)))
    got = {}
    for r in pairs.select("bucket", "id_a", "id_b").collect():
        got.setdefault((r.id_a, r.id_b), []).append((r.bucket >> 32) + (1 << 31) if r.bucket < 0 else "sim")
    for a, b in combinations(rows, 2):
        shared = [slot for slot in range(len(names)) if a[2 + slot] is not None and a[2 + slot] == b[2 + slot]]
        found = got.get((a[0], b[0]), [])
        assert found == shared[:1] if shared else set(found) <= {"sim"} and (a[1] != b[1] or len(found) == 10)


def test_unlike_lines_seldom_share_a_key_by_words():
    """Long lines, half of whose words are a dozen frequent ones: few pairs meet, and they grow with few of the lines."""
    rng = random.Random(21)
    frequent = "the of and to in a is was for on that it".split()
    lines = [" ".join(rng.choice(frequent) if rng.random() < 0.5 else "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(3, 9))) for _ in range(150)) for _ in range(1500)]
    keys = [Counter(k.drop_null().to_pylist()) for k in line_dedup.Lines(pa.array(lines)).word_keys()]
    assert sum(n * (n - 1) // 2 for k in keys for n in k.values()) < 100
    assert all(sum(k.values()) in (0, len(lines)) for k in keys)


def test_buckets_meet_whatever_the_batches_they_come_in():
    rng = random.Random(22)
    rows = sorted({(rng.choice([-5, -1, 0, *range(3, 40)]), rng.randrange(1000)) for _ in range(120)} | {(7, i) for i in range(50)})
    members = {}
    for bucket, i in rows:
        members.setdefault(bucket, []).append(i)
    want = sorted((bucket, i, ids[0], len(ids) > 2) for bucket, ids in members.items() for i in ids[1:])
    for size in (1, 2, 3, 7, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[at : at + size], strict=True)], ["bucket", "id"]) for at in range(0, len(rows), size)]
        got = [r for b in line_dedup._meeting(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert sorted(got) == want
    assert list(line_dedup._meeting(iter([]))) == []


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_close_simhashes_share_a_key(spark, blocks):
    rng = random.Random(blocks)
    pairs = []
    for _ in range(100):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), line_dedup.DISTANCE):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    keys = [line_dedup.block_keys(F.col(c), blocks) for c in "ab"]
    assert df.where(F.arrays_overlap(*keys)).count() == 100


def test_simhash_is_a_majority_of_bits():
    from quillstone.llm.words import Words, raw

    for line in ("one", "a b", "a b c", " ".join(f"w{i % 90}" for i in range(700))):
        h = Words(*raw(pa.array([line.replace("1", "0").translate(str.maketrans("23456789", "00000000"))]))).hashes()
        want = sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > len(h))
        assert line_dedup.simhash(line) == want


def brute_passages(rows):
    """Words that are left of each document, by comparing all spans as texts."""
    first, units = {}, {}
    for d, t in rows:
        s = passages.Sentences(pa.array([t], pa.string()))
        w = words(t)
        cuts = s.first.tolist()
        units[d] = [w[a:b] for a, b in pairwise(cuts)]
    spans = {}
    for d, u in units.items():
        for i in range(len(u)):
            for j in range(i + passages.SENTENCES, len(u) + 1):
                if sum(map(len, u[i:j])) >= passages.WORDS:
                    span = tuple(x for s in u[i:j] for x in s)
                    spans.setdefault(d, []).append((i, j, span))
                    first[span] = min(first.get(span, (d, i)), (d, i))
                    break
    out = {}
    for d, u in units.items():
        gone = {k for i, j, span in spans.get(d, []) if first[span] != (d, i) for k in range(i, j)}
        out[d] = [x for k, s in enumerate(u) if k not in gone for x in s]
    return out


def test_passages_match_brute_force(spark, odd_documents, no_documents):
    rng = random.Random(6)

    def sentence():
        return " ".join(rng.choice(["ab", "cd", "ef", "gh", "ij"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(2, 30))) + rng.choice(". ! ? ." .split()) + rng.choice([" ", "\n"])

    shared = ["".join(sentence() for _ in range(6)) for _ in range(5)]
    rows = [(i, "".join(sentence() if rng.random() < 0.7 else "cut off " + rng.choice(shared) for _ in range(rng.randint(0, 9)))) for i in range(50)]
    rows += [(50, None), (51, ""), (52, "Er. Er. Er. Er."), (53, shared[0] * 3), (54, "no full stop " * 40), (55, "no full stop " * 40)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int").repartition(3)
    got = {r.doc_id: r for r in passages.dedup_passages(df).collect()}
    want = brute_passages(rows)
    assert {d: words(r.text) for d, r in got.items()} == want
    assert sum(r["__n_removed"] for r in got.values()) > 30
    assert got[50].text is None and got[52].text == "Er. Er. Er. Er."
    assert all(r["__removed_words"] == len(words(dict(rows)[d])) - len(want[d]) for d, r in got.items())
    assert passages.dedup_passages(no_documents).count() == 0
    assert passages.dedup_passages(odd_documents).count() == odd_documents.count()
    assert line_dedup.dedup_lines(odd_documents).count() == odd_documents.count()
    assert minhash.near_duplicates(odd_documents).count() == odd_documents.count()


def test_passages_of_rows_without_ids_or_with_one_id(spark):
    shared = " ".join(f"s{i}." for i in range(40))
    rows = [(None, "a b. " + shared), (None, "c d. " + shared), (7, "e f. " + shared), (7, "g h. " + shared)]
    got = passages.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r["__n_removed"] > 0) for r in got) == [(False, False), (False, True), (True, True), (True, True)]


@pytest.mark.parametrize("sizes", [(60, 60), (14, 16), (12, 16), (3, 9)])
def test_any_51_shared_words_hold_a_span(spark, sizes):
    """Passages that begin and end anywhere, with sentences of so many words; 60: no punctuation within."""
    rng = random.Random(sum(sizes))

    def prose(n):
        out = []
        while len(out) < n:
            out += [f"w{rng.randrange(5000)}" for _ in range(rng.randint(*sizes))]
            out[-1] += "."
        at = rng.randrange(len(out) - n + 1)
        return out[at : at + n]

    rows = []
    for i in range(100):
        shared = prose(51)
        rows += [(2 * i, " ".join(prose(40) + shared + prose(40))), (2 * i + 1, " ".join(prose(33) + shared + prose(47)))]
    left = {r.doc_id: r["__removed_words"] for r in passages.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(left[2 * i] == 0 and 20 <= left[2 * i + 1] <= 51 for i in range(100))
