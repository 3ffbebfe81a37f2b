import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from streamwatch.llm import queries, simhash

from .conftest import ODD, SCHEMA


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{fingerprint: fingerprints reachable} by comparing all pairs."""
    left, classes = set(prints), []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            one = todo.pop()
            group.add(one)
            near = {other for other in left if (one ^ other).bit_count() <= 2}
            left -= near
            todo += near
        classes.append(group)
    return {one: group for group in classes for one in group}


def expected(rows):
    prints = [(doc, plain_fingerprint(text)) for doc, text in rows]
    reach = plain_components({p for _, p in prints})
    least = {}
    for doc, own in prints:
        for p in reach[own]:
            if doc is not None:
                least[p] = min(doc, least.get(p, doc))
    return sorted(((doc, f"{p:016x}", least.get(p)) for doc, p in prints), key=str)


def digests(found):
    return sorted(((r.doc_id, f"{r.fingerprint % 2**64:016x}", r.component_id) for r in found.collect()), key=str)


def _corpus():
    draw = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 50))) for _ in range(60)]
    base = draw.choices(words, k=200)
    for _ in range(80):
        own = list(base)
        own[draw.randrange(len(own))] = draw.choice(words)
        texts.append(" ".join(own))
    texts += [" ".join(base).upper()] * 12 + ["a b", "A\tb", "", None, " "]
    draw.shuffle(texts)
    return list(enumerate(texts))


def test_classes_against_all_pairs(spark, documents):
    rows = _corpus()
    found = digests(simhash.simhash_duplicates(documents(rows)))
    assert found == expected(rows)
    assert len({component for _, _, component in found}) < len(rows) - 50


def test_odd_documents(spark, odd, no_docs):
    assert digests(simhash.simhash_duplicates(odd)) == expected([row[:2] for row in ODD])
    crowded = odd.withColumns({name: F.lit("x") for name in ("fingerprint", "component_id", "key", "n", "spread")})
    assert digests(simhash.simhash_duplicates(crowded)) == expected([row[:2] for row in ODD])
    assert simhash.simhash_duplicates(no_docs).count() == 0


def test_only_documents_without_id(documents):
    found = simhash.simhash_duplicates(documents([(None, "one two three four"), (None, "one two three four")])).collect()
    assert [row.component_id for row in found] == [None, None]


def test_links_of_chosen_fingerprints(spark):
    """Chains, both differing bits in one segment or one in each, the sign bit, and neighbours three bits away."""
    draw = random.Random(2)
    values = {0, 1, 3, 1 << 63, (1 << 63) | (1 << 31), 7 << 40, (1 << 32) | 1}
    for _ in range(200):
        value = draw.getrandbits(64)
        values.add(value)
        for _ in range(3):
            for _ in range(draw.randint(1, 3)):
                value ^= 1 << draw.randrange(64)
            values.add(value)
    signed = {int(np.uint64(v).astype(np.int64)): v for v in values}
    links = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fingerprint long").repartition(3)).collect()
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for row in links:
        assert (signed[row.a] ^ signed[row.b]).bit_count() <= 2
        parent[find(signed[row.a])] = find(signed[row.b])
    reach = plain_components(values)
    for a in values:
        assert {b for b in values if find(a) == find(b)} == reach[a]


def test_many_copies_and_a_large_class(documents, monkeypatch):
    """Hot fingerprints and hot classes go another way, with the same result."""
    monkeypatch.setattr(simhash, "HOT_SHARE", 1 / 50)
    rows = _corpus()
    assert digests(simhash.simhash_duplicates(documents(rows))) == expected(rows)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{k % 91}" for k in range(3000))
    whole = plain_fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK_SHINGLES", 64)
    data = np.frombuffer(text.encode(), np.uint8)
    assert simhash.fingerprint(simhash.shingle_hashes(data, 3)) % 2**64 == whole


@pytest.mark.parametrize("rows", [_corpus()])
def test_query(spark, tmp_path, rows):
    folder = str(tmp_path)
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], SCHEMA).write.parquet(folder + "/documents.parquet")
    found = queries.op13_simhash(spark, folder)
    assert found.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    assert sorted((tuple(row) for row in found.collect()), key=str) == expected(rows)
