"""Sentence spans against a plain double loop."""

import random

from airsight.llm import substring_dedup as s

SCHEMA = "doc_id long, text string, n_removed string"


def tables():
    rng = random.Random(9)
    sentence = lambda: " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 5, 8, 11, 25]))) + rng.choice([". ", "! ", "?\n", "\n", ".\n\n"])
    passage = "".join(sentence() for _ in range(7))
    rows = []
    for i in range(60):
        parts = [sentence() for _ in range(rng.randrange(0, 12))]
        if i % 3 == 0:
            parts.insert(rng.randrange(len(parts) + 1), passage)
        rows.append((i, "".join(parts)))
    rows += [(70, None), (71, ""), (72, " \n "), (73, rows[3][1]), (74, passage * 3), (None, passage), (75, "no end"), (75, "no end")]
    return rows


def every_run(rows, sentences=2, least=15):
    """Every run with enough sentences and words: (id, what is left of the text, number of cut sentences) of each row."""
    first, runs = {}, []
    for k, (doc, text) in enumerate(rows):
        words = [p.split() for p in s.sentences(text) if not p.isspace()]
        place = -1 if doc is None else doc
        for at in range(len(words)):
            for end in range(at + sentences, len(words) + 1):
                run = tuple(map(tuple, words[at:end]))
                if sum(map(len, run)) >= least:
                    runs.append((k, at, run, (place, at)))
                    first[run] = min(first.get(run, (place, at)), (place, at))
    gone = [set() for _ in rows]
    for k, at, run, place in runs:
        if place != first[run]:
            gone[k].update(range(at, at + len(run)))
    out = []
    for k, (doc, text) in enumerate(rows):
        n, kept = -1, []
        for p in s.sentences(text):
            n += not p.isspace()
            kept += [p] * (n not in gone[k])
        out.append((doc, "".join(kept) if gone[k] else text, len(gone[k])))
    return out


def test_spans_equal_brute_force(spark):
    rows = tables()
    found = s.drop_repeated_spans(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(4))
    assert found.columns == ["doc_id", "text", "n_removed", "_n_removed"]
    got = sorted(((r["doc_id"], r["text"], r["_n_removed"]) for r in found.collect()), key=repr)
    want = sorted(every_run(rows), key=repr)
    assert got == want and sum(n > 0 for _, _, n in want) > 15


def test_empty_table(spark):
    assert s.drop_repeated_spans(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sentences_cover_the_text():
    for t in ["A b. C d! E\nf g.\n\n h i... j? k", "  ", "", "x.y z. w", "...", "q?! r.  \n s"]:
        assert "".join(s.sentences(t)) == t
    assert s.sentences("A b. C d!*** x.y z\nw") == ["A b. ", "C d!*** ", "x.y z\n", "w"]
    long = "." * 200_000 + "x " + ".$" * 100_000  # linear in the text, whatever the marks
    assert "".join(s.sentences(long)) == long


def test_short_sentences(spark):
    rng = random.Random(4)
    word = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    ones = "".join(f"{word(1)}.\n" for _ in range(60))
    fours = "".join(f"{word(rng.randrange(1, 5))}! " for _ in range(40))
    tail = word(14) + ". " + "".join(f"{word(1)}. " for _ in range(6))  # the words stand before, so no span begins in its end
    rows = [(i, f"{word(3)}. {word(9)}. {p}{word(6)}. {word(7)}. ") for i, p in enumerate([ones, ones, fours, fours, tail, tail, ones[:40], ""])]
    rows += [(20, ones), (21, fours), (22, "go. " * 40), (23, "go. " * 10)]
    got = {r["doc_id"]: r["text"] for r in s.drop_repeated_spans(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()}
    assert [got[i] for i, _ in rows] == [t for _, t, _ in every_run(rows)]
    assert got[20] == got[21] == "" and not any(w in got[1] for w in ones.split()) and not any(w in got[5] for w in tail.split())
    assert got[22] == "go. " and got[23] == rows[-1][1]  # ten words are too few


def test_the_rule_is_its_two_numbers(spark):
    word = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    rows = [(i, f"{word(f'o{i}', 6)}. {word(f'x{n}', n - 5)}. {word(f'y{n}', 5)}. {word(f'p{i}', 6)}.") for i, n in enumerate([14, 14, 15, 15, 22, 22, 29, 29, 30, 30])]
    for sentences, least in ((2, 15), (2, 30), (3, 15), (1, 9)):
        found = s.drop_repeated_spans(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), least_sentences=sentences, least_words=least).orderBy("doc_id").collect()
        assert [(r["doc_id"], r["text"], r["_n_removed"]) for r in found] == every_run(rows, sentences, least)
        removed = [r["_n_removed"] for r in found][1::2]
        assert removed == {(2, 15): [0, 2, 2, 2, 2], (2, 30): [0, 0, 0, 0, 2], (3, 15): [0] * 5, (1, 9): [2] * 5}[sentences, least]
