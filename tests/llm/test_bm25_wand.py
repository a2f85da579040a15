import math
import random

import pyarrow as pa
from pyspark.sql import functions as F

from savora.llm import bm25_wand as bw
from llm_texts import prose

ITEMS = "item_id long, text string"


def test_wand_finds_every_item_that_reaches_the_threshold(spark):
    """Against scores of all items, over random passages of a small vocabulary."""
    draw = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(2, 12)))) for i in range(300)]
    index = next(bw.build_indexes(spark.createDataFrame(texts, ITEMS)))
    words = {i: t.split() for i, t in texts}
    mean = sum(map(len, words.values())) / len(words)
    distinct = [set(t) for t in {tuple(w) for w in words.values()}]
    df = {w: sum(w in d for d in distinct) for w in vocabulary}
    total = len(distinct)

    def score(item, passage):
        own = words[item]
        weight = {w: math.log1p((total - df[w] + 0.5) / (df[w] + 0.5)) * own.count(w) * 2.2 / (own.count(w) + 1.2 * (0.25 + 0.75 * len(own) / mean)) for w in own}
        return sum(v for w, v in weight.items() if w in passage) / sum(weight.values())

    numbers = {h: n for n, h in enumerate(index.hashes.tolist())}
    import numpy as np
    from savora.llm import byte_text
    for _ in range(60):
        passage = draw.choices(vocabulary, k=draw.randint(1, 15))
        raw = " ".join(passage).encode()
        starts, ends, _ = byte_text.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), byte_text.NOT_ALNUM)
        terms = sorted({numbers[h] for h in byte_text.word_hashes(np.frombuffer(raw, np.uint8), starts, ends).tolist() if h in numbers})
        found = {index.ids[i]: s for i, s in index.search(terms)}
        expected = {i: score(i, set(passage)) for i in words if score(i, set(passage)) >= 0.5 - 1e-9}
        assert set(found) == set(expected)
        assert all(abs(found[i] - min(1, expected[i])) < 1e-9 for i in found)


def leaks(docs, items):
    return {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in bw.find_leaks(docs, items).collect()}


def test_leaks_of_whole_items_only(spark, documents):
    first, second = prose(11, 40), prose(12, 25)
    question = " ".join(first.split()[:20])
    items = spark.createDataFrame([(7, first), (8, second), (9, second), (10, None), (11, "")], ITEMS)
    docs = documents([prose(1, 500) + " " + first + " " + prose(2, 300), second.upper(), question, prose(3, 900), None, "",
                      prose(4, 4000) + "\n" + second, first.replace(" ", "\t\n"), (50, second), (50, second)])
    assert leaks(docs, items) == {1: [7], 2: [8, 9], 3: [], 4: [], 5: [], 6: [], 7: [8, 9], 8: [7], 50: [8, 9]}


def test_one_changed_word_does_not_hide_an_item(spark, documents):
    """At each position of items whose answers have two to twenty words."""
    items = {n: prose(300 + n, 20, 99) + ". " + prose(400 + n, n, 99) for n in (2, 3, 4, 5, 8, 13, 20)}
    items[99] = prose(350, 30, 99)
    docs, expected = [], {}
    for n, text in items.items():
        words = text.split()
        for k in range(len(words)):
            docs.append((len(docs), prose(1, 40) + " " + " ".join([*words[:k], "zzqx", *words[k + 1:]]) + " " + prose(2, 40)))
            expected[len(docs) - 1] = [n]
    # the question alone, or with another answer, is none
    docs += [(-1, prose(308, 20, 99)), (-2, prose(308, 20, 99) + ". " + prose(600, 8, 99)), (-3, prose(302, 20, 99) + ". " + prose(601, 2, 99))]
    expected |= {-1: [], -2: [], -3: []}
    assert leaks(documents(docs), spark.createDataFrame(list(items.items()), ITEMS)) == expected


def test_copies_are_found_when_only_common_words_are_left(spark, documents):
    """Items of 14 words that many items hold and two of their own, both of which are changed in the copy."""
    draw = random.Random(9)
    common = [f"word{i}" for i in range(90)]
    items = [(i, " ".join([*draw.sample(common, 7), f"rare{i}a", *draw.sample(common, 7), f"own{i}b"])) for i in range(100)]
    held = {w: sum(w in t.split() for _, t in items) for w in common}
    assert sum(held.values()) / len(held) > 10
    docs = documents([(i, prose(i, 30) + " " + t.replace(f"rare{i}a", "zzq").replace(f"own{i}b", "qqz") + " " + prose(1000 + i, 30)) for i, t in items])
    found = leaks(docs, spark.createDataFrame(items, ITEMS))
    assert found == {i: [i] for i, _ in items}


def passages_of(text, width, step):
    words = bw.WORD.findall(text.lower())
    return [words[a:a + width] for a in range(0, max(1, len(words) - width + step), step)] if words else []


def test_whole_operator_against_every_item_in_every_passage(spark, documents):
    """Scores of all items over all passages, by the definition; items of common and rare words, copies with edits."""
    draw = random.Random(3)
    vocabulary = [f"v{i}" for i in range(70)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(4, 20))) + ". " + " ".join(draw.choices(vocabulary, k=draw.randint(2, 6)))) for i in range(80)]
    texts = []
    for i, (_, t) in enumerate(items):
        words = t.split()
        for _ in range(i % 4):
            words[draw.randrange(len(words))] = draw.choice([*vocabulary, "new"])
        texts.append(" ".join(draw.choices(vocabulary, k=draw.randint(0, 60))) + " " + " ".join(words) + " " + " ".join(draw.choices(vocabulary, k=draw.randint(0, 60))))
    own = {i: bw.WORD.findall(t.lower()) for i, t in items}
    distinct = [set(t) for t in {tuple(w) for w in own.values()}]
    mean, total = sum(map(len, own.values())) / len(own), len(distinct)
    idf = {w: math.log1p((total - n + 0.5) / (n + 0.5)) for w in vocabulary for n in [sum(w in d for d in distinct)]}
    longest = max(map(len, own.values()))
    expected = {}
    for d, text in enumerate(texts, 1):
        found = set()
        for passage in passages_of(text, 2 * longest, longest):
            for i, words in own.items():
                weight = {w: idf[w] * words.count(w) * 2.2 / (words.count(w) + 1.2 * (0.25 + 0.75 * len(words) / mean)) for w in words}
                if sum(v for w, v in weight.items() if w in passage) >= 0.5 * sum(weight.values()):
                    question, answer = bw.question_and_answer(dict(items)[i])
                    if min(bw.shares_of(question, answer, passage, bw.OVERLAP)) >= bw.OVERLAP:
                        found.add(i)
        expected[d] = sorted(found)
    assert sum(map(len, expected.values())) > 40
    assert leaks(documents(texts), spark.createDataFrame(items, ITEMS)) == expected


def test_index_travels_without_the_package():
    """A process that cannot import the package unpickles and uses what is broadcast."""
    import subprocess
    import sys
    from pyspark import cloudpickle
    items = [(1, "alpha beta gamma delta"), (2, "alpha epsilon zeta eta")]
    df = {w: sum(w in t for _, t in items) for _, t in items for w in t.split()}
    packed = cloudpickle.dumps(bw.Index(items, df, 2, 4.0))
    code = "import sys, pickle, pyarrow as pa; i = pickle.loads(sys.stdin.buffer.read()); assert not any(m.startswith('savora') for m in sys.modules); print([[x['item_id'] for x in r] for r in i.leaks(pa.array(['Alpha beta gamma delta', 'zeta']), 0.7)])"
    done = subprocess.run([sys.executable, "-c", code], input=packed, capture_output=True, cwd="/", env={"PATH": "/usr/bin"})
    assert done.stdout.decode().strip() == "[[1], []]", done.stderr.decode()[-500:]


def test_edits_are_those_of_the_plain_table():
    draw = random.Random(5)
    for _ in range(300):
        wanted, passage = draw.choices("abcd", k=draw.randint(1, 9)), draw.choices("abcde", k=draw.randint(0, 14))
        above = [0] * (len(passage) + 1)
        for i, w in enumerate(wanted, 1):
            row = [i]
            for j, p in enumerate(passage, 1):
                row.append(min(above[j - 1] + (w != p), above[j] + 1, row[-1] + 1))
            above = row
        assert bw.edits(wanted, passage) == min(above)


def test_blocks_of_items_agree_with_one_index(spark, documents):
    items = [(i, prose(100 + i, 30)) for i in range(12)]
    docs = documents([prose(i, 200) + " " + items[i][1] for i in range(12)]).withColumn("leaks", F.lit("clash")).withColumn("extra", F.lit(1))
    frame = spark.createDataFrame(items, ITEMS)
    out = docs
    one = leaks(docs, frame)
    assert sum(1 for _ in bw.build_indexes(frame, block_chars=500)) > 2
    found = {}
    for index in bw.build_indexes(frame, block_chars=500):
        for d, own in zip(docs.collect(), index.leaks(pa.array([r["text"] for r in docs.collect()]), bw.OVERLAP)):
            found.setdefault(d["doc_id"], []).extend(x["item_id"] for x in own)
    assert found == one == {i + 1: [i] for i in range(12)}
    assert bw.find_leaks(out, frame).columns.count("leaks") == 1


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], ITEMS)
    assert leaks(documents(["a b c"]), none) == {1: []}
    assert leaks(documents([]), spark.createDataFrame([(1, "a b c d")], ITEMS)) == {}


def test_query_finds_every_whole_item(spark):
    from savora.llm.all_queries import QUERIES
    folder = "/root/testdata/sf0.001"
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_benchmark_wand"](spark, folder).collect()}
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    whole = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    assert whole and whole <= found
