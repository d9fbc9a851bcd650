import hashlib
import re
from collections import defaultdict
from math import floor

from pyspark.sql import functions as F

from seisloom.llm import mixing


def fair_targets(words):
    """Reshares what is over a limit, round by round."""
    names = sorted((s for s in words if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in words if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, target, fixed = mixing.SHARE * sum(words.values()), {}, set()
    while True:
        rest, free = total - sum(target[s] for s in fixed), [s for s in names if s not in fixed]
        for s in free:
            target[s] = rest * weight[s] / sum(weight[f] for f in free)
        over = [s for s in free if target[s] > mixing.LIMIT * words[s]]
        if not over:
            return target
        for s in over:
            target[s] = float(mixing.LIMIT * words[s])
            fixed.add(s)


def check(rows, out):
    words = defaultdict(int)
    for r in rows:
        words[r[1]] += len(re.findall(mixing.WORD, r[2] or ""))
    targets = fair_targets(dict(words))
    taken = defaultdict(int)
    for r in out:
        taken[r.source] += r.taken
        assert abs(r.target - targets[r.source]) < 1e-6 and r.source_size == words[r.source] and 0 <= r.taken <= 2 * r.size
    for s, t in targets.items():
        assert taken[s] == floor(t + 1e-9)
    return targets


def test_targets_and_cuts(spark):
    rows = [(i, f"s{i % 5}" if i % 5 else None, "w " * (i * 7 % 50)) for i in range(300)] + [(900 + i, "hot", "x " * 500) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix_sources(df).collect()
    check(rows, out)
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in out) == sorted((r.doc_id, r.taken) for r in again)
    key = lambda i: int(hashlib.md5(f"{i}{mixing.SEED}".encode()).hexdigest()[:15], 16)
    for s in {r.source for r in out}:
        mine = sorted((r for r in out if r.source == s and r.size), key=lambda r: key(r.doc_id))
        passes = [r.taken / r.size for r in mine]
        assert all(a >= b for a, b in zip(passes, passes[1:], strict=False))  # whole passes, then a prefix


def test_cases(docs, empty):
    out = mixing.mix_sources(docs)
    assert out.columns == [*docs.columns, "size", "source_size", "target", "taken"]
    check([(r.doc_id, r.source, r.text) for r in docs.collect()], out.collect())
    whole = mixing.take_documents(out)
    assert whole.columns == docs.columns
    counted = whole.groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert max(r.n for r in counted) <= 4 and mixing.mix_sources(empty).count() == 0


def test_clashing_columns_stay(spark):
    inside = ["held", "src", "src_null", "key", "tie", "bucket", "before", "end", "words", "level", "w", "cap", "END", "Key_"]
    inside = [c for i, c in enumerate(inside) if c.lower() not in [x.lower() for x in inside[:i]]]
    rows = [(i, f"s{i % 3}", "w " * (i % 11), *[f"{c}{i}" for c in inside]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, " + ", ".join(f"`{c}` string" for c in inside))
    out = mixing.mix_sources(df)
    assert out.columns == [*df.columns, "size", "source_size", "target", "taken"]
    assert sorted(tuple(r)[: len(df.columns)] for r in out.collect()) == rows
    check([r[:3] for r in rows], out.collect())


def test_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    out = mixing.op3_mixing(spark, sf)
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken", "source"]
    assert sorted(map(tuple, out.collect())) == sorted(duckdb.sql(mixing.ORACLE).fetchall())
