"""The pipeline against its stages done by hand, and on odd tables."""

import collections
import zlib

import numpy as np
import odd
import pyarrow as pa
from conftest import SMALL
from pyspark.sql import functions as F
from test_brute import groups, parts, plain_alignment, words

import corpus_pipeline
from fleetprep.cluster import BATCH_BYTES
from fleetprep.llm import ngram_join, quality_classifier, token_files


def test_each_stage_against_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    good, once, clean, mixed, tokens = (f for _, f in corpus_pipeline.STAGES)
    columns = docs.columns

    kept = good(spark, docs, SMALL)
    rejected = {r["doc_id"] for r in quality_classifier.score(docs, labels).where("predicted = 0").collect()}
    assert kept.columns == columns and 0 < len(rejected) < 100
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert set(rows) == {r["doc_id"] for r in docs.collect()} - rejected

    kept = once(spark, kept, SMALL)
    want = {d for d, _, c in groups([(d, r["text"]) for d, r in rows.items()]) if d == c}
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert kept.columns == columns and set(rows) == want

    kept = clean(spark, kept, SMALL)
    items = [parts(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    grams = {tuple(i[k : k + 3]) for i in items for k in range(len(i) - 2)}

    def hit(text):
        w = parts(text)
        return any(tuple(w[k : k + 3]) in grams for k in range(len(w) - 2)) and any(plain_alignment(i, w) >= len(i) for i in items)

    want = {d for d, r in rows.items() if not hit(r["text"])}
    assert len(want) < len(rows)
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert kept.columns == columns and set(rows) == want

    kept = mixed(spark, kept, SMALL)
    taken = collections.Counter(r["doc_id"] for r in kept.collect())
    assert kept.columns == columns and set(taken) <= want and max(taken.values()) <= 2
    total = sum(len(words(r["text"])) for r in rows.values())
    assert abs(sum(n * len(words(rows[d]["text"])) for d, n in taken.items()) - 1.5 * total) < 0.05 * total

    out = tokens(spark, kept, SMALL).collect()
    library = Tokenizer.from_file(token_files.tokenizer_path())
    want = collections.Counter()
    for d, n in taken.items():
        ids = np.array([*library.encode(rows[d]["text"], add_special_tokens=False).ids, 2], "<u4")
        want[d, len(ids), zlib.crc32(ids.tobytes())] = n
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == want
    assert collections.Counter(tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()) == collections.Counter(tuple(r) for r in out)


def test_odd_and_empty_tables(spark, folder):
    odd.labels(spark).write.parquet(f"{folder}/labels.parquet")
    odd.items(spark).write.parquet(f"{folder}/benchmark.parquet")
    for rows in (odd.ROWS, []):
        docs = odd.documents(spark, rows, more=True)
        for clash in ("a.b", "mix_id", "Mix_Copies", "mix_copy_", "_mix_id"):
            docs = docs.withColumn(clash, F.lit(1))
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, folder)
            assert kept.columns == docs.columns, name
            if not rows:
                assert kept.count() == 0
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(rows)
    once = corpus_pipeline.one_of_each_group(spark, odd.documents(spark), folder)
    assert {1, 2, 3} & {r["doc_id"] for r in once.collect()} == {1}
    clean = corpus_pipeline.not_in_benchmark(spark, odd.documents(spark), folder)
    assert not {1, 2, 3} & {r["doc_id"] for r in clean.collect()}


def test_rows_go_to_workers_in_small_batches(spark):
    """What a worker and its executor hold at once; a size that the session sets itself stays."""
    docs = spark.range(6000, numPartitions=1).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 150), x -> uuid())) AS text")
    some = docs.limit(20)
    labels = some.selectExpr("doc_id", "doc_id % 2 AS quality")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    for work in (lambda: quality_classifier.accepted(some, labels), lambda: ngram_join.similar(some)):
        spark.conf.unset(BATCH_BYTES)
        assert work().count() > 0
        sizes = [r["size"] for r in docs.mapInArrow(run, "size long").collect()]
        assert sum(sizes) > 30 << 20 and max(sizes) < 2 << 20
    spark.conf.set(BATCH_BYTES, "8m")
    assert ngram_join.similar(some).count() == 20 and spark.conf.get(BATCH_BYTES) in ("8m", str(8 << 20), f"{8 << 20}b")
    spark.conf.unset(BATCH_BYTES)


def test_sketch_cells_stop_at_their_largest_value():
    rng = np.random.default_rng(5)
    counts = np.zeros(1 << ngram_join.SKETCH_BITS, np.uint8)
    slices = [np.concatenate((rng.integers(0, 1 << 63, 3000, np.uint64), np.full(200, 7 << 50, np.uint64))) for _ in range(3)]
    for shingles in slices:
        ngram_join.count_cells(counts, shingles)
    plain = np.bincount(np.concatenate(slices) >> np.uint64(64 - ngram_join.SKETCH_BITS), minlength=len(counts))
    assert plain.max() >= 600 and (counts == np.minimum(plain, 255)).all()


def test_tasks_of_a_worker_share_the_tokenizer():
    """It is read once by each process; the words that a task keeps are its own."""
    one, other = (token_files.Encoder(token_files.tokenizer_path()) for _ in range(2))
    assert one.tokenizer is other.tokenizer
    ids, sizes = one.encode(pa.array(["several words", ""], pa.large_string()))
    assert len(one.keys) == 2 and not len(other.keys)
    again, _ = other.encode(pa.array(["several words", ""], pa.large_string()))
    assert ids.tolist() == again.tolist() and sizes.tolist()[1] == 1
