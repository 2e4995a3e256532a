import public_tokenizers as P
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from quirework.llm.packing import rank_encoder  # noqa: E402
from quirework.llm.secretscan import redact, scan_text  # noqa: E402
from tests.llm.test_hostrules import brute as statistics  # noqa: E402
from tests.llm.test_minhash import brute as components  # noqa: E402


def test_stages_equal_brute_force(spark, tmp_path):
    rows = []
    for i in range(30):
        words = [f"w{(i * 7 + j * 13) % 997}x{i // 3 if i % 3 else i}" for j in range(60)]
        rows.append((i, " ".join(words) + (f' token = "{i:032x}"' if i % 5 == 0 else ""), "en", f"s{i % 4}", 0))
    rows += [(100, "short", "en", "s1", 5), (101, None, "en", "s1", None), (102, "again and " * 50, "en", None, 1), (103, rows[4][1], "en", "s0", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    left = [(i, t) for i, t, *_ in rows if not statistics(t)[-1]]
    comp = components(left, 5)
    left = [(i, redact(t, scan_text(t))) for i, t in left if comp[i] == i]
    encode = rank_encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    total = {}
    for r in got:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: len(encode(t)) + 1 for i, t in left}
    assert any("[SECRET]" in t for _, t in left) and 103 not in total


def test_stages_keep_columns_and_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
