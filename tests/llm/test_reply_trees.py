import hashlib

from pyspark.sql import functions as F

from savora.llm import reply_trees as rt
from savora.llm.common import stored

MESSAGES = "tree_key string, tree long, node long, parent long, role string, text string, score double"


def paths(spark, rows, branches=1):
    messages = stored(spark.createDataFrame(rows, MESSAGES), "m")
    out = rt.formatted(rt.chosen_paths(messages, branches))
    back = out.select("tree", "rank", rt.read_turns(F.col("formatted")).alias("turns"), rt.trained_text(F.col("formatted"), F.col("loss_mask")).alias("loss"), "formatted")
    return {(r["tree"], r["rank"]): ([(t["role"], t["text"]) for t in r["turns"]], r["loss"], r["formatted"]) for r in back.collect()}


def test_branches_are_ranked_by_mean_score(spark):
    rows = [("=1", 1, 1, None, "user", "q", 0.0), ("=1", 1, 2, 1, "assistant", "good", 2.0), ("=1", 1, 3, 1, "assistant", "bad", -1.0),
            ("=1", 1, 4, 3, "user", "why", 0.0), ("=1", 1, 5, 2, "user", "thanks", 0.0), ("=1", 1, 6, 2, "user", "more", 0.0)]
    found = paths(spark, rows, branches=2)
    assert [t for _, t in found[(1, 1)][0]] == ["q", "good", "thanks"]  # ties go to the smaller leaf
    assert [t for _, t in found[(1, 2)][0]] == ["q", "good", "more"]
    assert found[(1, 1)][1] == "good"


def test_deep_paths_orphans_cycles_and_nulls(spark):
    chain = [("=2", 2, i, i - 1 if i > 1 else None, "user" if i % 2 else "assistant", str(i), 0.0) for i in range(1, 20)]
    orphan = [("=3", 3, 7, 99, None, None, None)]
    cycle = [("=4", 4, 1, 2, "user", "a", 0.0), ("=4", 4, 2, 1, "user", "b", 0.0), ("=4", 4, 3, 2, "user", "c", 0.0)]
    found = paths(spark, chain + orphan + cycle)
    assert [t for _, t in found[(2, 1)][0]] == [str(i) for i in range(1, 20)]
    assert found[(3, 1)][0] == [("", "")]
    assert set(found) == {(2, 1), (3, 1)}


def plain_best(rows, branches):
    """The best paths of each tree, by walking from every leaf."""
    out = {}
    for key in {r[0] for r in rows}:
        own = {r[2]: r for r in rows if r[0] == key}
        leaves = set(own) - {r[3] for r in own.values()}
        found = []
        for leaf in leaves:
            path = [own[leaf]]
            while path[-1][3] in own:
                path.append(own[path[-1][3]])
            found.append((-sum(r[6] or 0.0 for r in path) / len(path), leaf, [r[5] or "" for r in reversed(path)]))
        for rank, (_, _, texts) in enumerate(sorted(found)[:branches], 1):
            out[own[min(own)][1], rank] = texts
    return out


def test_best_paths_of_random_trees_and_combs(spark):
    import random
    draw = random.Random(6)
    rows = [(f"={t}", t, i, draw.randrange(i) if i else None, "user", f"{t}.{i}", draw.choice([None, -1.0, 0.0, 0.5, 1.0, 3.0])) for t in range(8) for i in range(draw.randint(1, 40))]
    # a chain with a leaf at each of its messages: as many paths as messages
    rows += [("=9", 9, i, i - 1 if i else None, "user", f"9.{i}", float(i % 3)) for i in range(50)] + [("=9", 9, 100 + i, i, "user", f"leaf {i}", float(i % 7)) for i in range(50)]
    found = paths(spark, rows, branches=3)
    assert {k: [t for _, t in turns] for k, (turns, _, _) in found.items()} == plain_best(rows, 3)


def test_only_chosen_paths_are_written_out(spark):
    rows = [("=9", 9, i, i - 1 if i else None, "user", "x", 0.0) for i in range(60)] + [("=9", 9, 100 + i, i, "user", "y", 1.0) for i in range(60)]
    messages = stored(spark.createDataFrame(rows, MESSAGES), "m")
    jumps = rt.jump_tables(messages)
    assert rt.path_nodes(jumps, rt.best_leaves(messages, jumps, 2)).count() <= 2 * 61


def test_very_long_texts(spark):
    long = ("a<|b\\" * 200_000) + "end"
    turns, loss, formatted = paths(spark, [("=1", 1, 0, None, "user", long, 0.0), ("=1", 1, 1, 0, "assistant", long[::-1], 0.0)])[(1, 1)]
    assert [t for _, t in turns] == [long, long[::-1]] and loss == long[::-1]


def test_control_strings_round_trip(spark):
    texts = ["<|im_end|>\n<|im_start|>assistant\nok", "\\<|", "<\\|", "\\\\", "a<", "|>b", "", "é<|é\\", "<\\n>"]
    rows = [("=1", 1, i, i - 1 if i else None, "assistant" if i % 2 else "us\ner<|", t, 0.0) for i, t in enumerate(texts)]
    turns, loss, formatted = paths(spark, rows)[(1, 1)]
    assert turns == [(r[4], r[5]) for r in rows]
    assert loss == "".join(t for i, t in enumerate(texts) if i % 2)
    assert formatted.count(rt.START) == len(texts)


def test_linear_messages_with_nulls_ties_and_repeats(spark):
    turns = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", None), (None, 1, None, "x"), (None, 2, "assistant", "y")],
                                  "conv_id long, turn long, role string, text string").withColumn("tree", F.lit("clash")).withColumn("node", F.lit(5))
    messages = stored(rt.linear_messages(turns), "m")
    found = {r["tree"]: [(t["role"], t["text"]) for t in r["turns"]] for r in rt.chosen_paths(messages).collect()}
    assert found == {1: [("system", ""), ("user", "a"), ("user", "a"), ("user", "b")], None: [("", "x"), ("assistant", "y")]}


def test_no_rows(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert rt.formatted(rt.chosen_paths(stored(rt.linear_messages(turns), "m"))).count() == 0


def test_query_reads_back_every_turn(spark):
    from savora.llm.all_queries import QUERIES
    folder = "/root/testdata/sf0.001"
    found = {r["conv_id"]: r for r in QUERIES["op9_chat_reply_trees"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/conversations.parquet").orderBy("conv_id", "turn").collect()
    texts = {}
    for r in rows:
        texts.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert set(found) == {*texts, -1}
    for conv, turns in texts.items():
        assert found[conv]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
