"""Toxic words in a small share of the toxic texts enter the lexicon."""

from landsync.llm import toxicity


def test_rare_toxic_words(spark):
    rare = ["zlorgan", "quabbix"]
    rows = [(k, f"common words of text {'fine' if k % 2 else 'well'} vrakkest", 1) for k in range(400)]
    rows = [(k, t.replace("vrakkest", rare[k // 4 % 2]) if k < 8 else t, y) for k, t, y in rows]
    rows += [(k, "common words of text fine and well", 0) for k in range(400, 1200)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    matcher = toxicity.Matcher(lexicon)
    none = matcher.score("common words")
    assert all(matcher.score(f"a {w} here") > none for w in [*rare, "vrakkest"])
    assert len(lexicon.weights) == 3
