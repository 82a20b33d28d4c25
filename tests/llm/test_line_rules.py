import re
from collections import Counter

from voltway.llm import line_rules as L


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    again = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = text.split("\n")
    dup = sum(bool(line.strip(" \t\n\r\x0b\x0c")) and line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def test_measures_equal_brute_force(docs, texts):
    rows = L.judged(docs).collect()
    found = sorted((r[0], *r[1:6], r["base_failed"]) for r in rows if r[0] is not None)
    expected = []
    for i, t in texts:
        m = measures(t)
        expected.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert found == sorted(e for e in expected if e[0] is not None)
    assert len(rows) == len(texts) and all(not r["kept"] for r in rows if r["base_failed"])


def test_rules_remove_lines_and_reject_documents(spark):
    clean = "\n".join(" ".join(f"w{i}{j}" for j in range(12)) + "." for i in range(6))
    menu = "Home | About | News | Contact | Shop"
    loud = "\n".join(" ".join(f"W{i}{j}!!" for j in range(12)) for i in range(6))
    df = spark.createDataFrame([(1, clean), (2, f"{menu}\n{clean}\nRead our privacy policy here"), (3, loud), (4, f"{clean}\n{loud}")], "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in L.cleaned(df).collect()}
    assert kept == {1: clean, 2: clean}
    by = {r["doc_id"]: r["removed_by"] for r in L.judged(df).collect()}
    assert by == {1: "", 2: "boilerplate,navigation", 3: "punctuation", 4: "punctuation"}


def test_columns_stay_and_empty_table(docs, nothing):
    assert L.cleaned(docs).columns == docs.columns and L.cleaned(nothing).count() == 0 and L.judged(nothing).count() == 0


def test_long_lines_are_judged_like_short_ones():
    menu = " ".join(f"Page {i} »" for i in range(60))
    assert L.line_fault(menu.encode(), menu.encode().split()) == "navigation"
    furniture = " ".join(["please read our privacy policy and cookie policy before you go on"] * 5)
    assert len(furniture.split()) > 40 and L.line_fault(furniture.encode(), furniture.encode().split()) == "boilerplate"
    prose = "the court held that the privacy policy of the firm " + " ".join(f"word{i}" for i in range(200))
    assert L.line_fault(prose.encode(), prose.encode().split()) is None


def test_lines_in_many_places_are_boilerplate_and_lines_of_copies_are_not(spark):
    """A line between ever other neighbours goes; a passage that only copies share stays."""
    rows = [(i, f"opening {i} of its own\nshared banner of the site\nclosing {i} of its own") for i in range(60)]
    rows += [(100 + i, "a copied opening\na copied middle line\na copied end") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert L.common_lines(docs) == {L.line_hash(b"shared banner of the site")}
    found = {r["doc_id"]: r for r in L.judged(docs).collect()}
    assert found[0]["removed_by"] == "boilerplate" and found[0]["n_removed_words"] == 5 and found[100]["removed_by"] == ""
    assert L.common_lines(docs.limit(0)) == frozenset()


def line_fails(line):
    """The line rules read from the docstring, over characters."""
    words = re.findall(r"[^\x20\x09-\x0D]+", line)
    n, low = len(words), line.lower()
    marks = len(re.findall(r"[#*$%&|<>]", line))
    bars = [w for w in words if w in ("|", "»", "›", "•", "·")]
    menus = [low.count(s) for s in "»›•·"]
    return (
        (marks > 0 and n >= 4 and (len(bars) >= 3 and 4 * len(bars) >= n or 3 * marks >= n))
        or (n >= 4 and 2 * len([w for w in words if re.search(r"(!!|\?\?|\.\.\.)$", w)]) > n)
        or (max(menus) >= 3 and 14 * sum(menus) >= n)
        or 0 < n <= 40 * len(re.findall("|".join(L.BOILERPLATE), low))
    )


def kept_texts(texts):
    """(verdict, removed words, cleaned text) of each text, by plain walks over all of them."""
    strip = lambda line: line.strip(" \t\n\r\x0b\x0c")
    places = {}
    for text in texts:
        own = [strip(x) for x in (text or "").split("\n") if strip(x)]
        for i, line in enumerate(own):
            places.setdefault(line, set()).add((own[i - 1] if i else None, own[i + 1] if i + 1 < len(own) else None))
    common = {line for line, at in places.items() if len(at) >= max(20, 0.01 * len(texts))}
    for text in texts:
        lines, stays, lost = (text or "").split("\n"), [], 0
        for i, line in enumerate(lines):
            n = len(re.findall(r"[^\x20\x09-\x0D]+", line))
            if n and (n >= 3 and line in lines[:i] or line_fails(line) or strip(line) in common):
                lost += n
            else:
                stays.append(line)
        n, *_, again = measures(text)
        yield n >= 50 and 100 * again <= 50 * n and lost <= 0.4 * n, lost, "\n".join(stays)


def test_verdicts_and_cleaned_texts_equal_brute_force(spark):
    """Lines of all kinds, put together at random: verdicts, removed words and cleaned texts of a plain walk."""
    import random

    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("na", "tü", "ker", "so") for b in ("la", "men", "st", "i", "x9")]
    odd = ["Home | About | News | Shop", "Start » Shop » Cart » Pay", "one » two » three", "Read our Privacy Policy here", "buy!! now!! cheap!! today", "so... he... went... away... then",
           "# * $ price", "a b c d | e | f | g", "• first • second • third thing", "  the banner of the site\t", "the banner of the site", "Lorem ipsum dolor " + "word " * 60, "a & b & c & d", "?? !! ..."]
    texts = [None, "", "\n \n"]
    for _ in range(300):
        lines = [" ".join(rng.choices(words, k=rng.randrange(3, 14))) + rng.choice([".", "", "!", "..."]) for _ in range(rng.randrange(3, 14))]
        for _ in range(rng.choice([0, 1, 2, 6])):
            lines.insert(rng.randrange(len(lines) + 1), rng.choice([*odd, "", " ", lines[0]]))
        texts.append("\n".join(lines))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = list(kept_texts(texts))
    found = {r["doc_id"]: (r["kept"], r["n_removed_words"]) for r in L.judged(docs).collect()}
    assert [found[i] for i in range(len(texts))] == [(k, n) for k, n, _ in expected]
    assert {r["doc_id"]: r["text"] for r in L.cleaned(docs).collect()} == {i: t for i, (k, _, t) in enumerate(expected) if k}
    verdicts = [k for k, _, _ in expected]
    assert 40 < sum(verdicts) < 260 and L.line_hash(b"the banner of the site") in L.common_lines(docs)
