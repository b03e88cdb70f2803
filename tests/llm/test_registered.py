"""The registered corpus queries that SQL cannot express, recomputed plainly, and the pipeline on edge rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from secflow.llm import compression, graph, jaccard_join, language_id, queries, secrets, toxicity
from tests.llm.conftest import EDGE_ROWS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def _remainder(doc, n):
    return zlib.crc32(str(doc).encode()) % n


def test_op1_verdicts(spark, texts):
    packer = zstandard.ZstdCompressor(level=3)

    def fits(b):
        _, low, high = [x for x in compression.BANDS if len(b) >= x[0]][-1]
        return low <= len(packer.compress(b)) / len(b) <= high

    for r in queries.op1_compression_bands(spark, SF).collect():
        w, b = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id]), texts[r.doc_id].encode()
        times = Counter(zip(w, w[1:], w[2:]))
        hit = {i + k for i in range(len(w) - 2) if times[tuple(w[i:i + 3])] > 1 for k in range(3)}
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        pieces = [b[i:i + 4096] for i in range(0, len(b), 4096)]
        kept = not failed and fits(b) and 2 * sum(not fits(p) for p in pieces) <= len(pieces)
        assert (r.n_words, r.n_repeat_words, r.base_failed, r.kept) == (len(w), len(hit), failed, kept)


def test_op4_folds_and_limit(spark, texts):
    rows = {r.doc_id: r for r in queries.op4_toxicity(spark, SF).collect()}
    assert set(rows) == set(texts)
    assert all(r.held_out == (_remainder(d, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for d, r in rows.items())
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if _remainder(r.doc_id, 3) != 1 and r.toxic is not None]
    model = toxicity.fit([texts[d] for d, _ in labels], np.array([y for _, y in labels]))
    odds, rest = model.log_odds()
    for doc in sorted(texts)[:40]:
        gram = toxicity.subword_rows([texts[doc]])[1]
        plain = 1 / (1 + np.exp(-(sum(odds[g] for g in gram.tolist()) / (len(gram) + toxicity.PRIOR) + rest))) if len(gram) else 0.0
        assert rows[doc].score == pytest.approx(plain, abs=2e-3)


def test_op6_base_spans(spark, texts):
    kinds = {"assign": (re.compile(secrets.ASSIGN.replace("(?i:", "(?:(?i:").replace("api_?key)", "api_?key))")), 1, 6),
             "access": (re.compile(secrets.ACCESS), 0, 20), "hex": (re.compile(secrets.HEX), 0, 24)}
    for r in queries.op6_secret_scan(spark, SF).collect():
        found = [(m.start(), i, k, m.end()) for i, (k, (p, group, least)) in enumerate(kinds.items()) for m in p.finditer(texts[r.doc_id]) if len(m[group]) >= least]
        listed = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(f[2] == k for f in found) for k in kinds)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert ",".join(s for s in r.spans.split(",") if s and not s.startswith("random")) == listed


def test_op7_pieces_and_sequences(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = queries.op7_best_fit_packing(spark, SF).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, pieces in by_doc.items():
        ids = np.array(tokenizer.encode(texts[doc], add_special_tokens=False).ids + [0], "<u4")
        for i, r in enumerate(sorted(pieces, key=lambda p: p.piece)):
            own = ids[2048 * i:2048 * (i + 1)].tobytes()
            assert (r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) == (i, 2048 * i, len(own) // 4, zlib.crc32(own), own)
        assert 2048 * len(pieces) >= len(ids)
    assert set(by_doc) == set(texts)
    for places in by_sequence.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // 2048) + 1


def test_op10_predictions(spark, texts):
    rows = {r.doc_id: r for r in queries.op10_language_id(spark, SF).collect()}
    assert all(r.held_out == (_remainder(d, 5) == 0) and 0 <= r.score <= 1 for d, r in rows.items()) and set(rows) == set(texts)
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    known = [d for d, r in rows.items() if r.held_out and r.lang_pred != "und"]
    assert sum(rows[d].lang_pred == lang[d] for d in known) >= 0.95 * len(known)


def test_models_of_nothing(spark, edge):
    assert language_id.identify(edge, language_id.fit_languages(edge.limit(0))).where("lang_pred <> 'und'").count() == 0
    for rows in ([], [(1, 1), (2, 1)], [(1, None)]):
        model = toxicity.fit_toxicity(edge, spark.createDataFrame(rows, "doc_id long, toxic int"))
        assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(edge, model).collect())


def test_one_of_each_on_edge_rows(spark, edge):
    kept = jaccard_join.keep_one_of_each(edge)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == edge.columns and ids.count(8) == 1 and {4, 5, 7, 9, 10, 11} <= set(ids) and len(ids) < len(EDGE_ROWS)
    assert jaccard_join.keep_one_of_each(edge.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(700)] + [(900, 900)], "a long, b long")
    found = {r.node: r.component for r in graph.components(chain).collect()}
    assert found == {i: 0 for i in range(701)}


def test_pipeline_on_edge_rows(spark, edge, tmp_path):
    edge.withColumnsRenamed({"score": "n_chars"}).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, 1, 1), (10, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([("i", "password abc123XYZ"), (None, "a"), ("n", None)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "piece", "sequence_id", "offset", "ids"} <= set(out.columns) and out.count() >= 1
    empty = tmp_path / "none"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{name}.parquet")).limit(0).write.parquet(str(empty / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
