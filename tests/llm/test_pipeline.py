from __future__ import annotations

import base64
import hashlib
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DELETED = {c: None for c in [32, *range(9, 14)]}


def shingle_set(text):
    w = text.lower().encode().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes(rows):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * len(sets[i] | sets[j]) and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        least[g] = min(i, least.get(g, i))
    return sorted(least.values())


def test_each_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    # one document without letters, which the language stage rejects
    extra = docs.limit(1).withColumns({"doc_id": F.lit(10**6).cast("long"), "text": F.lit("123 ... 456")})
    docs = corpus_pipeline.materialise(docs.union(extra), "t")
    columns = docs.columns
    found = corpus_pipeline.materialise(corpus_pipeline.language(spark, docs, SMALL), "t")
    ids = {r.doc_id for r in found.select("doc_id").collect()}
    assert found.columns == columns
    assert {r.doc_id for r in docs.collect()} - ids == {10**6}

    rows = [(r.doc_id, r.text) for r in found.collect()]
    keep = {}
    for i, t in rows:
        bare = t.translate(DELETED)
        keep[bare] = min(keep.get(bare, (0, 0)), (-len(t), i)) if bare in keep else (-len(t), i)
    found = corpus_pipeline.materialise(corpus_pipeline.exact_copies(spark, found, SMALL), "t")
    rows = [(r.doc_id, r.text) for r in found.collect()]
    assert found.columns == columns and sorted(i for i, _ in rows) == sorted(i for _, i in keep.values())

    found = corpus_pipeline.materialise(corpus_pipeline.near_copies(spark, found, SMALL), "t")
    assert found.columns == columns and sorted(r.doc_id for r in found.collect()) == classes(rows)

    before = {r.doc_id: r for r in found.collect()}
    mixed = corpus_pipeline.materialise(corpus_pipeline.mixture(spark, found, SMALL), "t")
    assert mixed.columns == columns
    taken = Counter(r.doc_id for r in mixed.collect())
    assert set(taken) <= set(before) and max(taken.values()) <= 2
    size = {i: len(r.text.encode().split()) for i, r in before.items()}
    by_source, words, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, r in before.items():
        by_source[r.source] += size[i]
        words[r.source] += size[i] * taken[i]
        largest[r.source] = max(largest[r.source], size[i])
    assert abs(sum(words.values()) - 1.5 * sum(by_source.values())) <= sum(largest.values())

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    last = corpus_pipeline.tokens(spark, mixed, SMALL).collect()
    assert Counter(r.doc_id for r in last) == taken
    for r in last:
        text = before[r.doc_id].text
        assert list(r.ids) == own.encode_ordinary(text) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
        for name, stage in stages.items():
            docs = corpus_pipeline.materialise(stage(spark, docs, SMALL), "t")
            assert name == "tokens" or docs.columns == columns


def test_run_applies_the_stages(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.count() > 100
