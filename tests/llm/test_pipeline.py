"""The pipeline's stages on a small corpus with planted cases."""

import numpy as np

import corpus_pipeline
from rowcast.llm import queries


def tables(spark, folder, seed=11):
    rng = np.random.default_rng(seed)
    vocab = [f"v{i}" for i in range(4000)]
    bad = ["vilea", "vileb", "nastyc", "nastyd"]
    say = lambda n: list(rng.choice(vocab, n))
    item = " ".join(say(25))
    rows, labels, kind = [], [], {}
    for i in range(400):
        words = say(int(rng.integers(60, 200)))
        kind[i] = "clean"
        if i % 7 == 3:
            for _ in range(4):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(bad)))
            kind[i] = "toxic"
        elif i % 41 == 5:
            words[30:30] = item.upper().split(" ")[3:18]
            kind[i] = "leak"
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(kind[i] == "toxic")))
    clean = [i for i in kind if kind[i] == "clean"]
    for k, i in enumerate(clean[:20]):
        words = rows[i][1].split(" ")
        if k % 2:
            words[len(words) // 2] = "changed"
        rows.append((1000 + k, " ".join(words)))
        kind[1000 + k] = "exact" if k % 2 == 0 else "near"
    rows += [(2000, None), (2001, "")]
    kind |= {2000: "clean", 2001: "copy"}
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return dict(rows), kind


def test_stages_drop_what_they_should_and_keep_the_rest(spark, scratch):
    texts, kind = tables(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    names = docs.columns
    kept = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, scratch).collect(), docs.schema)
        assert kept.columns == names
        seen.append({r.doc_id for r in kept.collect()})
    assert seen[0] == {i for i in kind if kind[i] != "toxic"}
    gone = seen[0] - seen[1]
    assert {kind[i] for i in gone} <= {"exact", "near", "copy"}
    assert all(i in gone for i in kind if kind[i] in ("exact", "copy"))
    assert sum(kind[i] == "near" for i in gone) >= 5
    assert seen[1] - seen[2] == {i for i in kind if kind[i] == "leak"}

    out = corpus_pipeline.run(spark, scratch).collect()
    assert {r.doc_id for r in out} == seen[2]
    used = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 1024


def test_every_operator_has_one_query():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.queries()) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"
    ]
