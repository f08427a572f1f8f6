"""The pipeline against its plain steps, with planted cases."""

import random

import corpus_pipeline
from weekloom.llm import quality, sentencepiece_codec
from weekloom.llm.common import table
from tests.conftest import SF

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(draw, n):
    return " ".join(draw.choice(["river", "stone", "winter", "market", "letter", "garden"]) + str(draw.randint(0, 400)) for _ in range(n))


def test_planted_cases(spark, tmp_path):
    draw = random.Random(9)
    item = prose(draw, 30)
    base = prose(draw, 80)
    near = base.split()
    near[40] = "changed"
    clean = [(i, prose(draw, 60 + i)) for i in range(20)]
    planted = [(100, base), (101, base), (102, " ".join(near)), (103, prose(draw, 20) + " " + item.upper() + ". " + prose(draw, 20)),
               (104, prose(draw, 40) + " mail jo.doe@mail.example.com or +1 (269) 555-3296 now " + prose(draw, 5)),
               (105, "too short"), (106, None), (107, " ".join(w + "###" for w in prose(draw, 50).split())), (100, base), (None, prose(draw, 55))]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in clean + planted]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == {i for i, _ in clean} | {100, 104, None}
    codec = sentencepiece_codec.codec_of(sentencepiece_codec.load())
    assert codec.decode([out[3]["ids"]]) == [dict(clean)[3]]
    masked = codec.decode([out[104]["ids"]])[0]
    assert "[EMAIL]" in masked and "[PHONE]" in masked and "example.com" not in masked and "555" not in masked
    assert all(r["parity"] and r["round_trip"] for r in out.values())


def test_stages_keep_the_columns_and_shrink(spark):
    docs = table(spark, SF, "documents")
    seen = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        kept = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert kept <= seen and kept
        docs, seen = out, kept
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_quality_stage_follows_the_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    texts = {r["doc_id"]: quality.Text(r["text"] or "") for r in docs.collect()}
    wrong = [i for i, q in known.items() if i in texts and not quality.base_failed(texts[i]) and (i in kept) != (q == 1)]
    assert len(wrong) <= 0.02 * len(known)
