import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from streamwatch.llm import collocations, queries

from .conftest import ODD, SCHEMA


def plain_phrases(rows, longest=3, least=10, percent=50, top=2000):
    """rows: (lang, text)."""
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for m in range(1, longest + 1):
                own.update(tuple(words[k : k + m]) for k in range(len(words) - m + 1))
    result = []
    for lang, own in counts.items():
        candidates = {p: f for p, f in own.items() if len(p) > 1 and f >= least}
        covered = Counter()
        for p, f in candidates.items():
            for m in range(2, len(p)):
                for k in range(len(p) - m + 1):
                    covered[p[k : k + m]] = max(covered[p[k : k + m]], f)
        found = []
        for p, a in candidates.items():
            if covered[p] and 100 * covered[p] >= percent * a:
                continue
            score, _, l, r = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), l, r))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        result += [(lang, k + 1, p, a, l, r, sizes[lang], score) for k, (score, a, p, l, r) in enumerate(found[:top])]
    return sorted(result)


def _corpus(seed=4, n=80):
    draw = random.Random(seed)
    words = ["the", "The", "of", "a", "b'c", "é", "日本", "x-y", "|", "#"] + [f"w{k}" for k in range(12)]
    weights = [30, 5, 12] + [4] * (len(words) - 3)
    rows = []
    for k in range(n):
        text = ""
        for _ in range(draw.randint(0, 60)):
            text += draw.choices(words, weights)[0] + draw.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\n", "!? ", ":"])
        rows.append((draw.choice(["en", "en", "en", "fr", None, "und"]), text))
    rows += [("en", "new york city " * 15), ("en", "the new york times. " * 6), (None, "one two " * 12)]
    return rows


def _docs(spark, rows):
    return spark.createDataFrame([(k, text, lang, "s", 1) for k, (lang, text) in enumerate(rows)], SCHEMA).repartition(3)


def _rows(found):
    return sorted(tuple(row) for row in found.collect())


def test_phrases_against_plain_python(spark):
    rows = _corpus()
    expected = plain_phrases(rows)
    assert len(expected) > 15
    found = collocations.mine_phrases(_docs(spark, rows))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and {kind for _, kind in found.dtypes} == {"string", "bigint"}
    assert _rows(found) == expected


@pytest.mark.parametrize("options", [{"longest": 2, "least": 3}, {"longest": 4, "least": 2, "percent": 80}, {"least": 1, "top": 7}])
def test_parameters(spark, options):
    rows = _corpus(seed=6, n=30)
    assert _rows(collocations.mine_phrases(_docs(spark, rows), **options)) == plain_phrases(rows, **options)


class _Locally:
    """Runs the functions of mapInArrow here, since settings of the driver do not reach Python workers."""

    def __init__(self, batches):
        self.batches = batches

    def mapInArrow(self, function, schema):  # noqa: N802
        return _Locally(list(function(iter(self.batches))))

    def repartition(self, *keys):
        return self

    def sortWithinPartitions(self, *keys):  # noqa: N802
        rows = pa.Table.from_batches(self.batches).sort_by([(key, "ascending") for key in keys])
        return _Locally(rows.to_batches(max_chunksize=7))


@pytest.mark.parametrize("buckets", [1, 5, 1000])
def test_blocks_parts_and_merges(monkeypatch, buckets):
    """Small blocks cut texts; frequent words have stripes in parts; stripes are merged a few entries at a time."""
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 50)
    monkeypatch.setattr(collocations, "MERGE_ENTRIES", 5)
    rows = _corpus(seed=9, n=40)
    batches = [pa.record_batch([pa.array([lang for lang, _ in own], pa.string()), pa.array([text for _, text in own])], ["lang", "text"]) for own in (rows[:20], rows[20:])]
    often = {"en": {"the": 4, "of": 2}, "und": {"the": 3}}
    merged = collocations.merged_stripes(collocations._partial(_Locally(batches), 3, often, buckets), 1).batches
    merged = [row for batch in merged for row in batch.to_pylist()]
    found = {(row["lang"], row["prefix"], row["tail"]): row["n"] for row in merged}
    assert len(found) == len(merged)
    expected = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text)):
            own = re.findall(r"[^\x20\x09]+", piece)
            for m in (1, 2, 3):
                expected.update(("und" if lang is None else lang, own[k], " ".join(own[k + 1 : k + m])) for k in range(len(own) - m + 1))
    assert found == expected


def test_words_of_all_languages_are_counted(spark):
    rows = _corpus(seed=9, n=40)
    often, sizes, total = collocations.frequent_words(_docs(spark, rows).select("lang", "text"))
    assert total == sum(row.n for row in sizes.collect()) and "the" in often["en"]


def test_frequent_words_change_nothing(spark, monkeypatch):
    rows = _corpus(seed=3)
    monkeypatch.setattr(collocations, "frequent_words", lambda found, whole=collocations.frequent_words: ({}, *whole(found)[1:]))
    assert _rows(collocations.mine_phrases(_docs(spark, rows))) == plain_phrases(rows)


def test_odd_documents(spark, odd, no_docs):
    expected = plain_phrases([(lang, text) for _, text, lang, *_ in ODD])
    assert expected and _rows(collocations.mine_phrases(odd)) == expected
    crowded = odd.withColumns({name: F.lit("x") for name in ("prefix", "tail", "n", "phrase", "part", "a", "rank", "spread")})
    assert _rows(collocations.mine_phrases(crowded)) == expected
    assert collocations.mine_phrases(no_docs).count() == 0


def test_scores_of_large_counts(spark, monkeypatch):
    """Products beyond 64 bits."""
    a, l, r = 3_000_000_000_019, 3_000_000_000_041, 9_000_000_000_007
    entries = [("en", "x", "", l), ("en", "x", "y", a), ("en", "y", "", r)]
    monkeypatch.setattr(collocations, "merged_stripes", lambda partial, least: spark.createDataFrame(entries, "lang string, prefix string, tail string, n long"))
    (row,) = collocations.mine_phrases(_docs(spark, [("en", "x y")])).collect()
    assert (row.a, row.l, row.r, row.score) == (a, l, r, 1000000 * a * a // (l * r))


def test_query(spark, tmp_path):
    rows, folder = _corpus(seed=8), str(tmp_path)
    _docs(spark, rows).write.parquet(folder + "/documents.parquet")
    assert _rows(queries.op11_phrase_mining(spark, folder)) == plain_phrases(rows)
