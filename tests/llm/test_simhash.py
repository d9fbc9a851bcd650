import random

import numpy as np
from xxhash import xxh64_intdigest

from seisloom.llm import golay, simhash


def brute_fingerprint(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(rows, distance):
    """(id, fp) -> smallest id reachable."""
    out = list(range(len(rows)))

    def find(i):
        while out[i] != i:
            i = out[i]
        return i

    for i, a in enumerate(rows):
        for j in range(i):
            if (a[1] ^ rows[j][1]).bit_count() <= distance:
                out[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(rows))]


def test_golay_shares_an_index_within_two_bits():
    draw = np.random.default_rng(2)
    for bits in (23, 18):
        v = draw.integers(0, 1 << bits, 4000)
        for flips in (0, 1, 2):
            w = v.copy()
            for _ in range(flips):
                w ^= 1 << draw.integers(0, bits, len(v))
            (a, on_a), (b, on_b) = golay.near_indices(v, bits), golay.near_indices(w, bits)
            same = (a[:, :, None] == b[:, None, :]) & on_a[:, :, None] & on_b[:, None, :]
            assert same.any((1, 2)).all()
    assert len(np.unique(golay.decode(np.arange(1 << 23)))) == 4096


def test_fingerprints(docs):
    out = simhash.fingerprints(docs).collect()
    want = sorted((brute_fingerprint(r.text, 4), str(r.doc_id)) for r in docs.collect())
    assert sorted((r.fp % (1 << 64), str(r.doc_id)) for r in out) == want


def test_links_against_brute_force(spark):
    draw = random.Random(4)
    base = [draw.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base[:25]:
        for _ in range(12):
            x = b
            for bit in draw.sample(range(64), draw.randrange(1, 7)):
                x ^= 1 << bit
            fps.add(x)
    hot = base[30]
    fps |= {hot ^ (1 << i) ^ (1 << j) for i in range(0, 40) for j in range(i)}  # a bucket of many near copies
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    found = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(df).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    rows = [(x, x) for x in fps]
    top = {x: x for x in fps}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in found:
        p, q = find(a), find(b)
        top[max(p, q)] = min(p, q)
    assert [find(x) for x in fps] == brute_components(rows, 4)


def test_components(spark, docs, empty):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(i, base + f" tail{i % 4}") for i in range(20, 40)] + [(50, "alone " * 5), (51, None), (52, " "), (None, base + " tail1")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    fps = [(i, brute_fingerprint(t, 4)) for i, t in rows]
    want = sorted(map(str, zip([i for i, _ in rows], [f"{f:016x}" for _, f in fps], brute_components(fps, 4), strict=True)))
    assert sorted(map(str, [tuple(r) for r in simhash.near_duplicates(df).collect()])) == want
    kept = simhash.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and ids.count(2) == 0 and ids.count(1) == 1 and ids.count(3) == 1 and 4 not in ids
    assert simhash.near_duplicates(empty).count() == 0


def test_keep_one_tells_documents_apart_by_id_and_text(spark):
    def prose(seed):
        draw = random.Random(seed)
        return " ".join(f"w{draw.randrange(10_000)}" for _ in range(200))

    unlike = [(None, prose(i), i) for i in range(60)]  # no ids, nothing alike
    one_id = [(7, prose(100), 100), (7, prose(101), 101)]  # two documents of one id
    near = [(None, prose(200), 200), (9, prose(200), 201), (8, prose(200), 202), (8, prose(200), 203)]  # copies: the smallest id, once
    no_ids = [(None, prose(300), 300), (None, prose(300), 301)]
    out = simhash.keep_one(spark.createDataFrame(unlike + one_id + near + no_ids, "doc_id long, text string, n int"))
    kept = sorted(r.n for r in out.collect())
    assert kept[:62] == [*range(60), 100, 101] and len(kept) == 64
    assert kept[62] in (202, 203) and kept[63] in (300, 301)


def test_near_copies_by_words(spark):
    """Copies of 300 words with 1 to 6 changed: whole groups go to one document, unlike texts of the same words stay."""
    draw, rows, origin = random.Random(9), [], {}
    vocabulary = [f"w{i}" for i in range(3000)]
    for group in range(60):
        text = draw.choices(vocabulary, k=300)
        for copy in range(4):
            other = list(text)
            for _ in range(0 if not copy else draw.randrange(1, 7)):
                other[draw.randrange(300)] = draw.choice(vocabulary)
            origin[len(rows)] = group
            rows.append((len(rows), " ".join(other)))
    for _ in range(200):
        rows.append((len(rows), " ".join(draw.choices(vocabulary, k=300))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.keep_one(df, width=5, distance=14, by_words=True).collect()}
    assert kept >= set(range(240, 440)) and {origin[i] for i in kept if i in origin} == set(range(60))

    def shingles(i):
        words = rows[i][1].split()
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    near = [i for i in range(240) if i % 4 and len(a := shingles(i) & shingles(i - i % 4)) / len(shingles(i) | shingles(i - i % 4)) >= 0.8 and a]
    assert len(near) > 100 and sum(i not in kept for i in near) >= 0.9 * len(near)


def test_keys_find_six_bits():
    draw = random.Random(6)
    for _ in range(3000):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randrange(7)):
            b ^= 1 << bit
        row, key = simhash.fuzzy_keys(np.array([a, b], np.uint64), exact=True)
        assert set(key[row == 0]) & set(key[row == 1])


def test_words_in_buckets_of_any_size():
    draw = random.Random(4)
    for n in (5, 200):
        fp = np.array([draw.getrandbits(64) if i % 3 else 7 << (i % 5) for i in range(n)], np.uint64)
        words = np.array([1 << (i % 9) for i in range(n)], np.uint64)
        words[: n // 2] = np.uint64(2**63 - 1)
        a, b = simhash.bucket_links(np.zeros(n, int), fp, 12, words)
        want = {(int(fp[i]), int(fp[j])) for i in range(n) for j in range(n) if (fp[i] ^ fp[j]).item().bit_count() <= 12 and (words[i] ^ words[j]).item().bit_count() <= 6}
        got = set(zip(a.tolist(), b.tolist()))
        assert got <= want
        assert components(got) == components(want)


def components(edges):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for x, y in sorted(edges):
        p, q = find(x), find(y)
        top[max(p, q)] = min(p, q)
    return {x: find(x) for x in top if any(x in e and e[0] != e[1] for e in edges)}


def test_edges_of_a_hot_group_do_not_grow_with_the_tasks(spark):
    """Near copies that meet in many buckets: an edge a member or so is joined, not one a member and task."""
    from seisloom.llm.common import connected_components

    base = random.Random(11).getrandbits(64)
    fps = [base, *(base ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)), *(random.Random(i).getrandbits(64) for i in range(200))]
    df = spark.createDataFrame([(int(x), int(x)) for x in np.array(fps, np.uint64).view(np.int64)], "fp long, words long")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plain, few = simhash.links(df, 14).cache(), simhash.thinned(simhash.links(df, 14, stars=True)).cache()
        many, left = plain.count(), few.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert many > 3 * len(fps) and left < 1.5 * len(fps)
    assert sorted(connected_components(few).collect()) == sorted(connected_components(plain).collect())


def test_stars_join_what_the_edges_join():
    draw = np.random.default_rng(3)
    for n in (0, 1, 50, 400):
        a, b = draw.integers(-200, 200, (2, n))
        star = simhash._stars(a, b)
        assert components(list(zip(*(x.tolist() for x in star), strict=True))) == components([e for e in zip(a.tolist(), b.tolist(), strict=True) if e[0] != e[1]])
        assert (star[0] > star[1]).all() and len(star[0]) == len(set(star[0].tolist()))


def test_the_search_does_not_give_an_edge_a_key_of_each_near_copy(spark, monkeypatch):
    """What the searches make of a group of near copies is a few rows a member, however many tasks see it, with the same components."""
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(f"x{n}" if i == n else w for i, w in enumerate(words)) for n in range(300)]
    df = spark.createDataFrame([(n, t) for n, t in enumerate([*texts, "something else altogether"])], "doc_id long, text string")
    made, real = [], simhash.links

    def counted(*args, **options):
        edges = real(*args, **options).cache()
        made.append(edges.count())
        return edges

    monkeypatch.setattr(simhash, "links", counted)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, width=5, distance=14, by_words=True).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out == {n: 0 for n in range(300)} | {300: 300}
    assert sum(made) < 12 * 300


def test_components_in_few_tasks(spark):
    from seisloom.llm.common import connected_components

    draw = random.Random(5)
    df = spark.createDataFrame([(draw.randrange(400), draw.randrange(400)) for _ in range(300)], "a long, b long")
    assert sorted(connected_components(df, 100).collect()) == sorted(connected_components(df).collect())
