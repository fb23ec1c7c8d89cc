import hashlib

import public_tokenizers as P
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.helpers import ODD, documents
from tests.llm.test_jaccard import shingles
from tillbook.llm import byte_bpe, lines, quality

SMALL = "/root/testdata/sf0.001"


def test_stages_one_after_another(spark, tmp_path):
    """Each stage against a plain account of its own input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    benchmark = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    names = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and len(after) == docs.count()
        if name == "quality":
            model = quality.trained(spark, SMALL, spark.read.parquet(f"{SMALL}/documents.parquet"))
            scores = {r.doc_id: r.score for r in quality.scored(spark.createDataFrame(list(before.values())), model).collect()}
            assert set(after) == {i for i in before if scores[i] >= quality.REJECT_BELOW}
        elif name == "line_dedup":
            assert set(after) == set(before)
            seen = set()
            for i in sorted(before):
                left = iter((after[i].text or "").split("\n"))
                nxt = next(left)
                for line in before[i].text.split("\n"):
                    key = lines.normalised(line.encode())
                    if nxt == line and (len(key.split()) < lines.LEAST_WORDS or key not in seen):
                        nxt = next(left, None)
                    else:
                        assert len(key.split()) >= lines.LEAST_WORDS
                    seen.add(key)
                assert after[i].n_chars == len(after[i].text)
        elif name == "jaccard_join":
            sets = {i: shingles(r.text) for i, r in before.items()}
            near = lambda a, b: a == b or (a & b and 5 * len(a & b) >= 4 * len(a | b))
            root = {i: i for i in sets}
            find = lambda i: i if root[i] == i else find(root[i])
            for i in sets:
                for j in sets:
                    if j < i and near(sets[i], sets[j]):
                        a, b = sorted((find(i), find(j)))
                        root[b] = a
            assert set(after) == {i for i in sets if find(i) == i}
        elif name == "decontaminate":
            hit = {i for i, r in before.items() if any(t in r.text for t in benchmark)}
            assert hit and set(after) == set(before) - hit
        if name != "byte_bpe":
            assert docs.columns == names
            before = after
    whole = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert set(after) == set(before)
    for i, r in after.items():
        assert r.text == before[i].text and r.bpe_ids == whole.encode_ordinary(r.text) and r.n_tokens == len(r.bpe_ids)
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()} == set(after)


def test_stages_take_odd_rows(spark):
    rows = documents(spark, ODD)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, SMALL)
        assert out.columns[: len(rows.columns)] == rows.columns, name
        assert out.count() <= len(ODD)
        assert stage(spark, rows.limit(0), SMALL).count() == 0


def test_every_operator_is_registered(spark):
    names = list(entry.queries())
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_digest_query(spark):
    rows = byte_bpe.op1_byte_bpe(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts.items()}
