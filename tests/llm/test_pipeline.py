from __future__ import annotations

import random

import corpus_pipeline as P


def test_stages_on_planted_rows(spark, tmp_path):
    rng = random.Random(6)
    text = lambda n=60: " ".join("".join(rng.choices(["ba", "co", "du", "fe", "gi"], k=3)) for _ in range(n))
    rows, labels = [], []
    for i in range(300):
        t = text() + (" vile scum" if i % 10 == 0 else "")
        rows.append((i, t, "en", f"s{i % 3}", len(t)))
        labels.append((i, 1, int(i % 10 == 0)))
    item = text(30)
    near = rows[11][1].split()
    near[30] = "changed"
    planted = {1000: rows[11][1], 1001: " ".join(near), 1002: "intro " + item + " end", 1003: "bad words: vile scum and vile scum", 1004: None, 1005: ""}
    rows += [(i, t, "en", None if i == 1004 else "s1", 0) for i, t in planted.items()]
    rows.append(rows[17])
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    kept, seen = docs, {}
    for k, (name, stage) in enumerate(P.STAGES[:-1]):
        out = stage(spark, kept, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{k}")
        kept = spark.read.parquet(f"{folder}/{k}")
        seen[name] = [r.doc_id for r in kept.collect()]
    toxic = {r[0] for r in rows[:300] if r[0] % 10 == 0} | {1003}
    clean = {r[0] for r in rows} - toxic
    assert set(seen["toxicity"]) == clean
    assert sorted(seen["near_duplicates"]) == sorted(clean - {1000, 1001})
    assert sorted(seen["decontamination"]) == sorted(clean - {1000, 1001, 1002})
    assert set(seen["mixing"]) <= set(seen["decontamination"]) and max(map(seen["mixing"].count, seen["mixing"])) <= 2
    shards = P.STAGES[-1][1](spark, kept, folder)
    assert sorted(r.doc_id for r in shards.collect()) == sorted(seen["mixing"])
    assert sorted(r.doc_id for r in P.run(spark, folder).collect()) == sorted(seen["mixing"])


def test_queries_with_sql(spark):
    import os

    import duckdb

    from tallyweave.llm import registry

    data = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for f in os.listdir(data):
        duck.execute(f"create view {f.split('.')[0]} as select * from '{data}/{f}'")
    assert [n for n in registry.QUERIES if n.startswith("op")] and set(registry.ORACLES) == {"op1_url_filters", "op9_mixing", "op10_decontamination"}
    for name, sql in registry.ORACLES.items():
        ours, theirs = registry.QUERIES[name](spark, data).toPandas(), duck.execute(sql).df()
        columns = sorted(theirs.columns)
        plain = lambda df, columns=columns: sorted(map(str, df[columns].astype(object).where(df[columns].notna(), None).round(6).values.tolist()))
        assert plain(ours) == plain(theirs)
