import random

import corpus_pipeline
from folioflow.llm.sharding import assign_shards

WORDS = "the of and to in that is was he for it with as his on be at by had river stone light winter garden bread house night morning letter field".split()


def test_run(spark, tmp_path):
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(WORDS) + rng.choice("abcdefg") for _ in range(n))
    item = say(20)
    docs, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        text = say(rng.randint(20, 60))
        docs.append((i, text.upper().replace(" ", "!! ") if bad else text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(not bad), 0))
    docs += [(1000 + k, docs[1][1] + f" tail{k}", "en", "s1", 1) for k in range(5)] + [(2000, f"{say(10)} {item} {say(10)}", "en", "s2", 1), (2001, None, None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"]
    rows = got.collect()
    ids = {r.doc_id for r in rows}
    assert not any(i % 5 == 0 for i in ids if i < 400) and 2000 not in ids and not ids & set(range(1000, 1005))
    by_id = {d[0]: d for d in docs}
    assert all(tuple(r)[:5] == by_id[r.doc_id] for r in rows)
    clean = [d for d in docs if d[0] < 400 and d[0] % 5]
    total, mixed = sum(len(d[1].split()) for d in clean), sum(len(r.text.split()) for r in rows)
    assert abs(mixed / total - 1.5) < 0.15 and max(sum(r.doc_id == i for r in rows) for i in ids) <= 2
    again = assign_shards(got.drop("shard"), "doc_id", 16)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    d = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, d, str(tmp_path))
        assert out.collect() == [] and (out.columns == d.columns or k == 4)
