import re

from voltway.llm import license_scan as L


def test_base_equals_brute_force(docs, texts, nothing):
    expected = []
    for i, t in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        places = [(at, label) for p, label in L.PHRASES.items() for at in range(len(words)) if words[at : at + len(p.split())] == p.split()]
        starts = [at for at, _ in places]
        expected.append((i, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))))
    found = [tuple(r)[:6] for r in L.scanned(docs).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str) and L.scanned(nothing).count() == 0


def test_notices_with_changed_words(spark):
    apache = dict(L.NOTICES[1:2])["apache-2.0"]
    changed = apache.replace("agreed to in writing", "agreed to by all sides in writing").replace("distributed under", "shipped under")
    df = spark.createDataFrame([(1, f"Intro here. {changed} More."), (2, "Released under the MIT License."), (3, "an apple a day under the license")], "doc_id long, text string")
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in L.scanned(df).collect()}
    assert found[1][0] == "apache-2.0" and 0.6 <= found[1][1] < 1
    assert found[2] == ("mit", 1.0) and found[3] == ("", 0.0)


def labels_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r["labels"], r["score"]) for r in L.scanned(docs).orderBy("doc_id").collect()]


def test_short_notices_in_other_wordings(spark):
    found = labels_of(
        spark,
        [
            "The code is licensed under the MIT License.",
            "Licensed under the Apache License 2.0",
            "Pictures: licensed under CC BY-NC-SA 4.0, see below.",
            "The committee met under the license of the mayor, and the license was free.",
            "He is licensed under the law of this work and of the public domain.",
        ],
    )
    assert found[:3] == [("mit", 0.8), ("apache-2.0", 7 / 8), ("cc-by,cc-by-nc-sa", 1.0)] and found[3:] == [("", 0.0)] * 2


def test_of_notices_that_differ_by_a_word_the_one_there_holds(spark):
    plain = "This work is licensed under a Creative Commons Attribution 4.0 International License."
    found = labels_of(spark, [plain, plain.replace("Attribution", "Attribution-NonCommercial"), plain.replace("Attribution", "Attribution-ShareAlike")])
    assert found == [("cc-by", 1.0), ("cc-by-nc", 1.0), ("cc-by-sa", 1.0)]
    both = labels_of(spark, [f"{plain} Code: released under the MIT License. {plain}"])
    assert both == [("cc-by,mit", 1.0)]


def test_every_notice_is_found_in_a_long_text_and_words_apart_are_not(spark):
    rest = " ".join(f"word{i}" for i in range(500))
    for (label, _), (labels, score) in zip(L.NOTICES, labels_of(spark, [f"{rest} {text} {rest}" for _, text in L.NOTICES]), strict=True):
        assert label in labels.split(",") and score == 1.0, label
    scattered = [" far ".join(text.split()) for _, text in L.NOTICES]
    assert all(not labels for labels, _ in labels_of(spark, scattered))


def test_spans_equal_a_search_word_by_word(spark):
    """Words dropped and put in at random: what holds is what a plain walk over diagonals finds."""
    import random

    rng = random.Random(5)
    texts = []
    for _ in range(60):
        words = rng.choice(L.NOTICES)[1].split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(words))
            words[at : at + rng.randrange(2)] = rng.choice([[], ["other"], ["the", "of"]])
        texts.append(f"so said {' '.join(words)} and no more of the rest")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((r["doc_id"], r["template"], r["first"], r["last"], r["found"]) for r in L.spans(docs).collect() if r["template"] >= 0 and not r["base"])
    expected = []
    for doc, text in enumerate(texts):
        words = L.words_of(text.encode())
        for number, (_, notice) in enumerate(L.NOTICES, start=len(L.PHRASES)):
            own = L.words_of(notice.encode())
            k = 4 if len(own) >= 16 else 2
            votes = sorted((p - q, q) for p in range(len(words) - k + 1) for q in range(len(own) - k + 1) if words[p : p + k] == own[q : q + k])
            groups = []
            for diagonal, q in votes:
                if not groups or diagonal - groups[-1][-1][0] > 3:
                    groups.append([])
                groups[-1].append((diagonal, q))
            for group in groups:
                covered = {q + i for _, q in group for i in range(k)}
                first, last = min(d + q for d, q in group), max(d + q + k - 1 for d, q in group)
                if len(covered) >= 0.7 * len(own) and last - first + 1 - len(covered) <= 0.3 * len(own) + 3 + 1e-9:
                    expected.append((doc, number, first, last, len(covered)))
    assert found == sorted(expected) and len(expected) > 40
