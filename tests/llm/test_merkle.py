import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streamwatch.llm import merkle, queries

from .conftest import ODD, SCHEMA


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return H(*("-" if value is None else f"{len(str(value).encode())}:{value}" for value in row))


def plain_tree(nodes):
    """Root, and for each node its path: (place, run) from the bottom up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            first = place // 16 * 16
            paths[k].append((place - first, nodes[first : first + 16]))
            at[k] = place // 16
        nodes = [H(*nodes[k : k + 16]) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def fold(digest, path):
    for place, run in path:
        digest = H(*run[:place], digest, *run[place + 1 :])
    return digest


def plain_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, found = [], []
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        root, paths = plain_tree([plain_leaf(row) for row in own])
        subroots.append(root)
        found.append((own, paths))
    root, tops = plain_tree(subroots)
    result = []
    for (own, paths), subroot, top in zip(found, subroots, tops):
        for row, path in zip(own, paths):
            siblings = [d for place, run in path + top for k, d in enumerate(run) if k != place]
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = fold(plain_leaf((*row[:4], text)), path + top)
            result.append((row[0], plain_leaf(row), subroot, root, H(*siblings), folded, folded == root))
    return sorted(result, key=str)


def _corpus(sizes, seed=1):
    draw, rows, doc = random.Random(seed), [], 0
    for source, n in sizes.items():
        for _ in range(n):
            doc += draw.randint(1, 3)
            rows.append((doc, source, "en", doc, draw.choice(["Ab é", "lower", "", "X" * 50, None])))
    draw.shuffle(rows)
    return rows


ORDERED = "doc_id long, source string, lang string, n_chars long, text string"


def _frame(spark, rows):
    return spark.createDataFrame(rows, ORDERED).repartition(3)


def _rows(found):
    return sorted(((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found.collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700))
def test_witnesses_of_a_tree(n):
    nodes = [H(str(k)) for k in range(n)]
    tree = merkle.WitnessTree()
    for node in nodes:
        tree.append(node)
    root, paths = plain_tree(nodes)
    assert tree.finish() == root and tree.witnesses == paths


def test_a_block_always_has_its_depth():
    tree = merkle.WitnessTree()
    tree.append(H("x"))
    assert tree.finish(3) == H(H(H(H("x")))) and len(tree.witnesses[0]) == 3


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_manifest_against_plain_python(spark, depth):
    rows = _corpus({"b": 300, "a": 17, None: 1, "é": 16, "": 33, "z": 2} | {f"s{k}": 1 for k in range(20)})
    assert _rows(merkle.proofs(merkle.build_manifest(_frame(spark, rows), depth=depth))) == plain_manifest(rows)


def test_whole_proofs(spark):
    rows = _corpus({"b": 40, "a": 3})
    for row in merkle.proofs(merkle.build_manifest(_frame(spark, rows), depth=1), whole=True).collect():
        assert hashlib.sha256(row.siblings.encode()).hexdigest() == row.proof_sha256 and len(row.siblings) % 64 == 0


def test_tampering_is_noticed(spark):
    rows = [(k, "a", "en", 1, "Text") for k in range(60)]
    found = merkle.proofs(merkle.build_manifest(_frame(spark, rows))).collect()
    assert {r.id for r in found if not r.verified} == {k for k in range(60) if zlib.crc32(str(k).encode()) % 5 == 0}


def test_odd_documents(spark, odd, no_docs):
    rows = [(i, source, lang, n, text) for i, text, lang, source, n in ODD]
    assert _rows(merkle.proofs(merkle.build_manifest(odd))) == plain_manifest(rows)
    crowded = odd.withColumns({name: F.lit("x") for name in ("tree", "id", "leaf", "place", "n", "part", "root", "block")})
    assert _rows(merkle.proofs(merkle.build_manifest(crowded))) == plain_manifest(rows)
    assert merkle.proofs(merkle.build_manifest(no_docs)).count() == 0


def test_query(spark, tmp_path):
    rows = _corpus({"b": 70, "a": 17, None: 5}, seed=4)
    folder = str(tmp_path)
    docs = spark.createDataFrame([(i, text, lang, source, n) for i, source, lang, n, text in rows], SCHEMA)
    docs.repartition(3).write.parquet(folder + "/documents.parquet")
    found = queries.op12_merkle_manifest(spark, folder)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(row) for row in found.collect()), key=str) == plain_manifest(rows)
