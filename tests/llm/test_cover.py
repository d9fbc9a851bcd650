import numpy as np

from seisloom.llm import cover


def brute(rows, cosine):
    ids, vectors = [r[0] for r in rows], []
    for _, v in rows:
        ok = v is not None and None not in v and np.isfinite(v).all() and np.any(v)
        vectors.append(np.array(v, np.float64) / np.linalg.norm(v) if ok else None)
    linked = [[j for j, b in enumerate(vectors) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= cosine] for i, a in enumerate(vectors)]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in linked[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        root = min((ids[j] for j in seen if ids[j] is not None), default=None)
        out.append((ids[i], len(linked[i]), root, ids[i] is not None and ids[i] == root))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted((tuple(r) for r in cover.similar_vectors(df).collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(8, 16))
    x = np.concatenate([centres[draw.integers(0, 8, 300)] + draw.normal(size=(300, 16)) * draw.choice([0.02, 0.3, 0.5], (300, 1)), draw.normal(size=(100, 16))])
    x = np.concatenate([x, x[:40], x[:5] * 2]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] * 16), (904, []), (905, [1.0, 2.0]), (906, [1.0, 2.0]), (907, [2.0, 4.1]), (908, [-1.0, 0.5]), (909, [3.0]), (910, [0.5]), (911, [-0.5]), (None, x[0].tolist()), (7, x[7].tolist())]
    monkeypatch.setattr(cover, "BLOCK", 64)
    assert run(spark, rows) == brute(rows, 0.9)


def test_hot_group_and_small_tables(spark):
    draw = np.random.default_rng(5)
    near = (np.ones(8) + draw.normal(size=(300, 8)) * 0.05).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(near)]
    assert run(spark, rows) == brute(rows, 0.9)
    assert run(spark, [(1, [1.0, 0.0])]) == [(1, 0, 1, True)]
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_layout_holds_all_near_pairs():
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 6))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    stats = {c: (int(draw.integers(1, 900)), float(draw.uniform(0, 0.4))) for c in range(40) if c % 7}
    layout = cover.Layout(centres, stats, 300, 0.447)
    blocks = layout.of_cells()
    assert set(blocks) == set(stats) and all(-(-stats[c][0] // 300) <= n for c, (_, n) in blocks.items())
    held = {}
    for c, (b, n) in blocks.items():
        if n == 1:
            held[b] = held.get(b, 0) + stats[c][0]
    assert max(held.values()) <= 300 and len(held) < len(stats)
    every = range(max(b + n for b, n in blocks.values()))
    beside = {b: set(layout.beside(b)) for b in every}
    assert all((a in beside[b]) == (b in beside[a]) for a in every for b in every)
    for c in stats:
        for e in stats:
            if np.linalg.norm(centres[c] - centres[e]) <= 0.447 + stats[c][1] + stats[e][1]:
                assert all(y in beside[x] for x in range(blocks[c][0], sum(blocks[c])) for y in range(blocks[e][0], sum(blocks[e])))
    assert sum(len(x) for x in beside.values()) < len(every) ** 2


def test_double_precision_columns_and_many_blocks(spark, monkeypatch):
    draw = np.random.default_rng(8)
    base = draw.normal(size=(12, 10))
    x = base[draw.integers(0, 12, 500)] + draw.normal(size=(500, 10)) * 0.2
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(cover, "LEAST_BLOCKS", 40)
    assert sorted((tuple(r) for r in cover.similar_vectors(df).collect()), key=str) == brute(rows, 0.9)
