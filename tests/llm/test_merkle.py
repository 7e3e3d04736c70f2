from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tabsmith.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, at, fanout):
    steps = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        steps.append((at - first, nodes[first:at] + nodes[at + 1 : first + fanout]))
        at //= fanout
    return steps


def brute_manifest(rows, fanout):
    """[(id, leaf, subroot, root, proof)] of (id, source, text) rows, sorted."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    first = lambda v: (v is not None, v if not isinstance(v, str) else v.encode())
    by = {}
    for i, source, text in rows:
        by.setdefault(source, []).append((first(i), digest(part(i) + part(source) + part(text)), i))
    sources = sorted(by, key=first)
    trees = {s: tree([leaf for _, leaf, _ in sorted(by[s], key=lambda r: r[:2])], fanout) for s in sources}
    top = tree([trees[s][-1][0] for s in sources], fanout)
    out = []
    for k, s in enumerate(sources):
        for at, (_, leaf, i) in enumerate(sorted(by[s], key=lambda r: r[:2])):
            out.append((i, leaf, trees[s][-1][0], top[-1][0], path(trees[s], at, fanout) + path(top, k, fanout)))
    return sorted(out, key=str)


def made(df):
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], [(p["at"], p["siblings"]) for p in r["proof"]]) for r in df.collect()), key=str)


def table_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, source string, text string, leaf int, proof string, place string")


@pytest.mark.parametrize("fanout,levels,sizes", [(3, 1, [31, 1, 2, 3, 4, 10, 28]), (2, 1, [17, 5, 1]), (3, 2, [100]), (3, 7, [50, 9, 1, 1])])
def test_equals_brute_force(spark, fanout, levels, sizes):
    rows = [(1000 * k + 7 * i % 101, f"s{k}é" if k else None, f"text {i}\n") for k, n in enumerate(sizes) for i in range(n)]
    found = merkle.manifest(table_of(spark, rows), ["doc_id", "source", "text"], fanout=fanout, block_levels=levels)
    assert made(found) == brute_manifest(rows, fanout)


def test_proofs_lead_to_the_root_and_tampering_does_not(spark):
    rows = [(i, f"s{i % 4}", f"a\nb{i}") for i in range(40)]
    docs = table_of(spark, rows).withColumn("other", merkle.leaf_digest(["doc_id", "source", F.translate("text", "\n", "")]))
    found = merkle.manifest(docs, ["doc_id", "source", "text"], block_levels=1, carry=["other", "leaf"])
    checked = found.select(
        (merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("true"),
        (merkle.fold(F.col("carried.other"), F.col("proof")) == F.col("root")).alias("false"),
        merkle.proof_digest(F.col("proof")).alias("d"), "proof", F.col("carried.leaf").alias("c"),
    ).collect()
    assert all(r["true"] and not r["false"] and r["c"] == 1 for r in checked)
    assert all(r["d"] == digest("".join(x for p in r["proof"] for x in p["siblings"])) for r in checked)


def test_nulls_repeated_rows_and_empty_tables(spark):
    rows = [(None, None, None), (None, "a", ""), (1, "a", None), (1, "a", "x"), (1, "a", "x"), (1, "a", "x"), (2, "", "-"), (2, "", None)]
    found = merkle.manifest(table_of(spark, rows), ["doc_id", "source", "text"], block_levels=1)
    assert made(found) == brute_manifest(rows, 3)
    assert merkle.manifest(table_of(spark, rows).limit(0), ["doc_id", "source", "text"]).collect() == []
    single = merkle.manifest(table_of(spark, rows[:1]), ["doc_id", "source", "text"]).collect()[0]
    assert single["leaf"] == single["subroot"] == single["root"] == digest("---") and single["proof"] == []
    with pytest.raises(ValueError):
        merkle.manifest(table_of(spark, rows), fanout=1)
