"""Chat samples: exact way back, budgets, masks, and conversations that fill many chunks."""

import hashlib
import random

import numpy as np
import pytest

from tablewarden.llm import chat
from tablewarden.llm.token_files import BYTE_VOCABULARY, word_encoder


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_marks_in_texts_come_back():
    rng = random.Random(2)
    bits = [*chat.MARKS, chat.ESCAPE, "[", "]", "<", ">", "/", "s", "INST", "<s", "[/", " ", "\n", "é"]
    for _ in range(3000):
        turns = [
            chat.Turn(rng.choice(["system", "user", "assistant", "tool", "", "[ROLE]x"]), "".join(rng.choices(bits, k=rng.randint(0, 9))))
            for _ in range(rng.randint(0, 4))
        ]
        sample = chat.START + "".join("".join(chat.formatted(*t)) for t in turns)
        assert chat.parsed(sample) == turns
        assert all(m not in chat.escaped(t.text) for t in turns for m in chat.MARKS)
    for bad in ("", "x", "<s>[INST]a", "<s>[/INST]", "a<s>"):
        with pytest.raises((ValueError, IndexError)):
            chat.parsed(bad)


def windows_one_by_one(sizes, first, retained, budget, turns, tokens):
    out = []
    while first < len(sizes):
        back = first
        while (
            back > 0
            and first - back < turns
            and sum(sizes[back - 1 : first]) <= tokens
            and retained + sum(sizes[back - 1 : first + 1]) <= budget
        ):
            back -= 1
        end = first + 1
        while end < len(sizes) and retained + sum(sizes[back : end + 1]) <= budget:
            end += 1
        out.append((back, first, end))
        first = end
    return out


def test_spans():
    rng = random.Random(8)
    for _ in range(2000):
        sizes = [rng.choice([1, 2, 3, 5, 8, 30]) for _ in range(rng.randint(1, 25))]
        args = rng.randint(0, len(sizes)), rng.randint(0, 6), rng.randint(5, 25), rng.randint(0, 4), rng.randint(0, 9)
        assert chat.spans(np.array(sizes), *args) == windows_one_by_one(sizes, *args)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    words = ["stone", "river", "</s>", "[INST]", "é", "漢字", "🙂", chat.ESCAPE, "light", "\n", "<s>"]
    text = lambda n: " ".join(rng.choices(words, k=n))
    out = []
    for conv in range(40):
        at = 0
        if conv % 3 == 0:
            out.append((conv, at, "system", text(8), 1, "x"))
            at = 1
        for i in range(rng.randint(0, 12)):
            out.append((conv, at + i, ("user", "assistant")[i % 2], text(rng.choice([0, 3, 20, 200])), 1, "x"))
    # one conversation holds most rows
    out += [(50, 0, "system", "be kind", 0, None)]
    out += [(50, 1 + i, rng.choice(["user", "assistant", "tool", None]), text(rng.choice([0, 5, 15, 40])), 0, None) for i in range(1500)]
    out += [(51, 3, "assistant", text(4000), 0, ""), (51, 1, "system", None, 0, ""), (51, 1, "user", "tie", 0, ""), (51, 1, "user", "tie", 0, "")]
    out += [(None, None, None, None, None, None)] * 300
    out += [(None, 4, "assistant", "late", None, None), (60, 0, "system", "alone", 1, ""), (61, 0, "assistant", "", 1, "")]
    rng.shuffle(out)
    return out


def wanted(rows):
    held = {}
    for conv, turn, role, text, *_ in rows:
        held.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in held.items():
        yield conv, [(r, t) for *_, r, t in sorted(turns, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))]


SCHEMA = "conv_id long, turn long, role string, text string, n_tokens long, chunk string"


@pytest.mark.parametrize("parts,chunks", [(1, 64), (6, 1)])
def test_samples(spark, rows, parts, chunks):
    convs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    budget = 300
    found = chat.samples(convs, budget=budget, history_tokens=60, chunk_budgets=chunks).collect()
    encoder = word_encoder(BYTE_VOCABULARY)
    by_conv = {}
    for r in sorted(found, key=lambda r: (r.chunk, r.window)):
        by_conv.setdefault(r.conv_id, []).append(r)
    want = dict(wanted(rows))
    assert set(by_conv) == set(want)
    repeated = 0
    for conv, turns in want.items():
        got, learned = [], []
        for r in by_conv[conv]:
            all_turns = chat.parsed(r.sample)
            assert len(all_turns) == r.n_turns
            if turns[0][0] == "system":
                assert tuple(all_turns[0]) == turns[0]
            # history is what stands right before the first new turn
            history = all_turns[1 : r.n_repeated] if turns[0][0] == "system" and got else all_turns[: r.n_repeated]
            assert [tuple(t) for t in history] == got[len(got) - len(history) :] and len(history) <= chat.HISTORY_TURNS
            repeated += len(history)
            got += [tuple(t) for t in all_turns[r.n_repeated :]]
            learned += [chat.unescaped(r.sample[t.start : t.end]) for t in r.targets]
            pieces = chat._MARK.split(r.sample)
            tokens = len(chat._MARK.findall(r.sample)) + sum(len(encoder.encode(p)) for p in pieces)
            assert r.n_tokens == tokens and r.over_budget == (tokens > budget)
            assert not r.over_budget or r.n_turns - r.n_repeated == 1 or all_turns[0].role == "system"
        assert got == turns
        assert learned == [t for role, t in turns if role == "assistant"]
    assert repeated > 50 and len(by_conv[50]) > 20 and any(r.over_budget for r in by_conv[51])
    assert (len({r.chunk for r in by_conv[50]}) > 20) == (chunks == 1)


def test_digests(spark, rows):
    def one(conv, turns):
        learned = "".join(t for role, t in turns if role == "assistant")
        return conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned)

    made = (-7, [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")])
    want = sorted([one(*made), *(one(*c) for c in wanted(rows))], key=str)
    convs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = chat.chat_digests(convs)
    assert found.columns == [f.split()[0] for f in chat.DIGESTS.split(", ")]
    got = found.collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == want
    assert all(r.formatted_chars > 0 for r in got)
    assert [tuple(r)[:5] for r in chat.chat_digests(convs.limit(0)).collect()] == [one(*made)]


def test_like_rows_are_cut_into_ranges(spark):
    rows = spark.createDataFrame([(None, None, "user", "")] * 4000, chat.TURNS)
    found = chat.placed(rows.repartition(4)).collect()
    assert {r.n_tokens for r in found} == {2} and sorted(r.place for r in found) == list(range(4000))
    assert sorted(r.before for r in found) == [2 * i for i in range(4000)]
