"""Learned abbreviations: counts, scores, and sentences that go on after them."""

import math
import re
from collections import Counter

from evidenza.operators import boundaries as B

TEXTS = (
    ["Fuels e.g. coal and gas fell. The rest grew.", "See the plan of Dr. Smith. It is new.", "Approx. half of it, i.e. ten units, came from wind."] * 12
    + ["Dr. J. Smith spoke. Nobody asked.", "The doctor came, i.e. he was late. He left.", "Coal e.g. lignite is cheap. So is gas."] * 9
    + ["What grew or fell late was new or wet or left or asked of gas or wind or cheap or spoke"] * 20
    + ["Rain fell on the town and on the fields", "The town was wet. The fields were wet"] * 20
)


def by_hand(texts):
    n, stopped = Counter(), Counter()
    for text in texts:
        for token in re.findall(r"[^\W\d_]+(?:\.[^\W\d_]+)*\.?", (text or "").lower()):
            n[token.rstrip(".")] += 1
            stopped[token.rstrip(".")] += token.endswith(".")
    rate = sum(stopped.values()) / sum(n.values())
    scores = {}
    for word in (w for w in n if stopped[w]):
        k, free = stopped[word], n[word] - stopped[word]
        null = k * math.log(rate) + free * math.log(1 - rate)
        alt = k * math.log(0.99) + free * math.log(0.01)
        letters, inner = len(word.replace(".", "")), word.count(".")
        scores[word] = (n[word], k, -2 * (null - alt) * math.exp(-letters) * (inner + 1) * letters ** -float(free))
    return scores


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)


def test_scores_equal_brute_force(spark):
    found = {r.word: (r.n, r.n_stopped, r.score) for r in B.abbreviation_scores(frame(spark, [*TEXTS, None, "", "..."])).collect()}
    expected = by_hand(TEXTS)
    assert found.keys() == expected.keys()
    assert all(f[:2] == e[:2] and math.isclose(f[2], e[2], abs_tol=1e-9) for f, e in ((found[w], expected[w]) for w in found))
    known = {w for w, x in found.items() if x[2] >= B.THRESHOLD}
    assert {"e.g", "i.e", "dr", "j"} <= known and not {"fell", "wet", "grew", "new"} & known


def test_sentences_go_on_after_abbreviations(spark):
    known = B.abbreviations(frame(spark, TEXTS))
    texts = ["Dr. J. Smith spoke. Fuels e.g. coal fell! Did it? Yes", None, "", "e.g.", "Dr. ", "One. Two."]
    found = B.sentence_rows(frame(spark, texts), ["id"], known).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.id, r.sentence_idx)):
        got.setdefault(r.id, []).append(r.sentence)
        assert r.sentence_idx == len(got[r.id]) - 1
    assert got == {
        0: ["Dr. J. Smith spoke.", "Fuels e.g. coal fell!", "Did it?", "Yes"], 3: ["e.g."], 4: ["Dr."], 5: ["One.", "Two."],
    }


def test_nothing_to_learn_from(spark):
    for texts in ([], [None], ["no stop at all"], ["Stop. Stop."]):
        df = frame(spark, texts) if texts else spark.createDataFrame([], "id int, text string")
        assert B.abbreviations(df).count() == 0
        assert B.sentence_rows(df, ["id"], B.abbreviations(df)).count() == {"no stop at all": 1, "Stop. Stop.": 2}.get((texts or [None])[0], 0)
