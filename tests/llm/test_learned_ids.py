"""Identifiers that no fixed form covers, learned from contexts; and very long texts."""

import random
import time

from tablewarden.llm import pii

WORDS = ["stone", "river", "light", "wind", "cloud", "field", "note", "page", "total", "chapter"]


def _key(rng, n=40):
    return "".join(rng.choices("0123456789abcdef", k=n))


def _planted():
    """Texts, and the places of identifiers that match no seed."""
    rng = random.Random(21)
    texts, wanted, clean = [], set(), set()
    prose = lambda: " ".join(rng.choices(WORDS, k=rng.randint(3, 12)))
    for n in range(360):
        unseen = f"{rng.choice('QZK')}{rng.randint(10, 99)}-{rng.randint(1000, 9999)}-{rng.choice('XY')}"
        kind = n % 6
        # a quarter of the values match no seed
        value = unseen if rng.random() < 0.25 else _key(rng)
        if kind in (0, 1):
            left, right = rng.choice(["token = ", 'token = "', "token: "]), ""
        elif kind == 2:  # only two words together say what it is; 'ref' alone is often harmless
            left, right = "access ref: ", ""
        elif kind == 3:
            left, value, right = "page ref: ", f"{rng.randint(100000, 999999)}", ""
        elif kind == 4:  # the word behind it says what it is
            left, right = "code: ", " badge"
        else:
            left, value, right = "code: ", f"v{rng.randint(10000, 99999)}", " colour"
        before = prose() + " and "
        texts.append(before + left + value + right + " " + prose())
        place = (n, len(before + left), len(before + left + value))
        if value == unseen:
            wanted.add(place)
        if kind in (3, 5):
            clean.add(place)
    return texts, wanted, clean


def _spans(frame):
    out = set()
    for r in frame.collect():
        for s in filter(None, r.spans.split(",")):
            kind, a, b = s.split(":")
            if kind == "id":
                out.add((r.doc_id, int(a), int(b)))
    return out


def test_unseen_identifiers_are_found_and_numbers_left_alone(spark):
    texts, wanted, clean = _planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = _spans(pii.find_personal_data(docs.repartition(1)))
    assert len(wanted) > 40 and len(wanted & found) >= 0.9 * len(wanted)
    assert not clean & found
    assert _spans(pii.find_personal_data(docs.repartition(7))) == found


def test_rounds_go_on_until_nothing_is_new(spark):
    # nine known values of a stage make two contexts confident, which know the nine of the next stage between them
    rows = []
    for k in range(5):
        for half, new in (("a", range(6)), ("b", range(3, 9))):
            rows += [(f"c{k}{half}:", f"value-{k}-{i}", k == 0) for i in range(9)]
            rows += [(f"c{k}{half}:", f"value-{k + 1}-{i}", False) for i in new]
    rows += [("half:", f"value-{k}-{i}", False) for k in (5, 9) for i in range(9)]
    rows += [("other:", f"value-9-{i}", False) for i in range(9)] + [("short:", "ab", True), ("short:", "cd", True)]
    values = spark.createDataFrame(rows, "cue string, value string, seed boolean")
    found = {r.cue for r in pii.confident_cues(values).collect()}
    assert found == {f"c{k}{half}:" for k in range(5) for half in "ab"}
    assert pii.confident_cues(values.limit(0)).collect() == []


def test_very_long_texts(spark):
    rng = random.Random(3)
    numbers = " ".join(str(rng.randint(10**13, 10**15)) + "x" for _ in range(40_000))
    mails = " ".join(f"a{i}@b.c" for i in range(40_000))
    docs = spark.createDataFrame([(1, numbers), (2, mails), (3, "token = " * 20_000)], "doc_id long, text string")
    start = time.time()
    found = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    assert time.time() - start < 60
    assert found[2].n_email == 40_000 and found[3].spans == ""
    last = found[2].spans.split(",")[-1]
    assert last == f"email:{len(mails) - len('a39999@b.c')}:{len(mails)}"
