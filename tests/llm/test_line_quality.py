import re

from pyspark.sql import functions as F

from savora.llm import line_quality as lq
from llm_texts import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_base_counts_match_a_plain_version(documents):
    texts = [prose(1, 60), "a b c d e f g h i " * 4, "", None, "one\x0btwo\x0cthree x\n\n one\n one", "x | y | z\n" * 3, "ééé ß 漢字 " * 12, prose(2, 3000)]
    rows = lq.judge(documents(texts)).orderBy("doc_id").collect()
    for text, r in zip(texts, rows):
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == by_hand(text or ""), text
        n, *_, repeat = by_hand(text or "")
        assert r["base_failed"] == (n < 20 or 100 * repeat > 30 * n)


def test_lines_are_judged_alone(documents):
    clean = prose(3, 40)
    menu = "Home | Shop | News | Help | Cart"
    loud = " ".join(w.upper() + "!!" for w in prose(4, 80).replace(".", "").split())
    signs = " ".join(w + "###" for w in prose(5, 80).split())
    rows = lq.judge(documents([clean, f"{menu}\n{clean}\nNext page\nWe use cookies here.", f"{clean}\n{loud}", f"{signs}\n{clean}", menu * 9])).orderBy("doc_id").collect()
    assert [r["kept"] for r in rows] == [True, True, False, False, False]
    assert rows[0]["clean_text"] == clean and rows[1]["clean_text"] == clean
    assert rows[1]["n_lines_removed"] == 3


def test_clashing_columns_repeats_and_no_rows(documents):
    docs = documents([(1, "a"), (1, "a"), (None, None)]).withColumn("kept", F.lit("x")).withColumn("extra", F.lit(1))
    out = lq.judge(docs)
    assert out.columns.count("kept") == 1 and dict(out.dtypes)["kept"] == "boolean"
    assert out.count() == 3 and not any(r["kept"] for r in out.collect())
    assert lq.judge(documents([])).count() == 0
