import json

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from savora.llm import line_quality as lq, secret_novelty as sn
from savora.llm.all_queries import ORACLE, QUERIES
from llm_texts import prose
from test_signature_tree import by_hand, edited


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secrets", "tokens"]


def test_pipeline_matches_a_plain_version(spark, tmp_path):
    item, base = prose(70, 35), prose(1, 120)
    key = "token = 9f8e7d6c5b4a39281706f5e4d3c2b1a0"
    texts = [base, edited(base, 5, 0.02), prose(2, 90) + "\n" + key + " is it.", prose(3, 200) + "\n" + item, "too short", None, "",
             " ".join(w + "###" for w in prose(4, 90).split()), prose(5, 60) + "\nHome | Shop | News | Help", prose(6, 3000), item, base]
    rows = [(i, t, "en", "s", len(t) if t is not None else None, "x") for i, t in enumerate(texts)] + [(0, base, "en", "s", 3, "x"), (None, prose(8, 50), None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    judged = {(r["doc_id"], r["text"]): r for r in lq.judge(spark.createDataFrame(rows, schema)).filter("kept").collect()}
    cleaned = {d: r["clean_text"] for (d, _), r in judged.items()}
    groups = by_hand([(d, t) for d, t in cleaned.items()])
    kept = {d: t for d, t in cleaned.items() if d is None or groups[d][1] == d}
    kept = {d: t for d, t in kept.items() if " ".join(item.split()) not in " ".join(t.split())}
    clean = {d: sn.cut(t, sn.scan_text(t)) for d, t in kept.items()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {d: library.encode(t, add_special_tokens=False).ids for d, t in clean.items()}

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["ids"] for r in out} == expected and len(out) == len(expected)
    assert set(expected) == {0, 2, 8, 9, None}
    assert "[ASSIGN]" in clean[2] and all(r["kept"] in ("x", None) for r in out)


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, leaks int, ids int, clean_text int"
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in ([], [(None,) * 9], [(1, prose(1, 40), "en", "s", 1, "a", 2, 3, 4)] * 2):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == schema.replace(",", "").split()[::2], name
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert last.count() == (1 if rows and rows[0][0] else 0)
        assert "text" not in last.columns and last.columns.count("ids") == 1


def test_every_operator_has_a_query():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(ORACLE) <= set(QUERIES) and json.dumps(ORACLE)
