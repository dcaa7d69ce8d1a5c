"""Ranked lexical search and chat formatting."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests_llm_helpers import corpus, frame, ready  # noqa: F401
from titlepulse.llm import chat_format, lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k):
    held = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    held = [(doc_id, terms) for doc_id, terms in held if terms]
    total, every = len(held), sum(sum(terms.values()) for _, terms in held)
    df = Counter(term for _, terms in held for term in terms)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, terms in held:
            m = 100 - 75 + (75 * sum(terms.values()) * total) // every
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * terms[t]) // (1000 * terms[t] + 8 * m))
                for t in plain_terms(text) if t in terms
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(sorted(scores, key=lambda s: s[:2] + (s[2] or 0,))[:k], 1)]
    return out


@pytest.mark.parametrize("k, bounds", [(3, {}), (10, {"block_items": 2}), (1, {"block_bytes": 1})])
def test_search_equals_brute_force(spark, frame, k, bounds):
    docs = [(n, (t or "") + " Été_x9" * (n or 0) if n and n % 7 == 0 else t) for n, t in corpus(5)]
    own = docs[0][1]
    items = [(1, own[:200]), (2, "été ÉTÉ x9 x9, nothing"), (2, "été ÉTÉ x9 x9, nothing"), (None, own), (3, None), (4, "..."), (5, "absent"), (6, "aé bé " * 3000)]
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, score long, term long")
    found = lexical_search.search(frame(docs), asked, k, **bounds).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, found), key=key) == sorted(plain_search(docs, items, k), key=key)


def test_search_without_rows(spark, frame):
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for docs in ([], [(1, None), (2, ""), (3, " .,")]):
        assert lexical_search.search(frame(docs), asked).collect() == []
    assert lexical_search.search(frame([(1, "a")]), asked.limit(0)).collect() == []


def conversation_rows(seed=3):
    rng = random.Random(seed)
    bits = [*chat_format.INSTRUCTIONS.control, "\\", "\\\\", "[", "]", "<", "INST]", "[\\INST]", "s>", " ", "\n", "é", "x", "/", "|end|>", "$1", "𝄞"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", "<|text|>\\", None]) if conv % 3 else ("assistant" if turn % 2 else "user"), "".join(rng.choice(bits) for _ in range(rng.randint(0, 9)))))
    rows += [(50, 0, "user", None), (50, 1, "assistant", ""), (51, 0, "user", "a " * 100_000), (51, 0, "user", "a " * 100_000), (51, None, "system", "s")]
    return rows + [(None, 1, "user", "u"), (None, 0, "system", "t"), (None, None, None, None)]


def plain_conversations(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for _, _, r, t in sorted(own)] for conv, own in held.items()}


def test_formatted_conversations_read_back(spark):
    rows = conversation_rows()
    held = spark.createDataFrame([(*r, 1, True) for r in rows], "conv_id long, turn long, role string, text string, position long, valid boolean")
    formatted = chat_format.conversations(held)
    found = formatted.select("*", chat_format.read_back(F.col("formatted")).alias("read"), chat_format.loss_text(F.col("segments")).alias("loss_text")).collect()
    wanted = plain_conversations(rows)
    assert {r.conv_id for r in found} == set(wanted) and len(found) == len(wanted)
    for r in found:
        own = wanted[r.conv_id]
        assert [tuple(t) for t in r["read"]] == own
        assert r.loss_text == "".join(t for role, t in own if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
        steps = list(zip(["", *[role for role, _ in own]], [role for role, _ in own]))
        bad = [n for n, (a, b) in enumerate(steps, 1) if b not in chat_format.INSTRUCTIONS.follows.get(a if n > 1 else "", ()) or (n > 1 and a == "")]
        assert r.first_bad == (bad[0] if bad else None) and r.valid == (not bad) and r.complete == (own[-1][0] == "assistant")
    again = {r.conv_id: r for r in chat_format.digest(formatted).collect()}
    for conv, own in wanted.items():
        assert again[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert again[conv].n_turns == len(own)


def test_slices_of_long_conversations_fit_together(spark):
    rows = [(7, n, "assistant" if n % 2 else "user", f"text {n} [INST]") for n in range(23)] + [(8, n * 5, "user", "x") for n in range(3)]
    held = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key = lambda r: (r.conv_id, r.position)
    whole = sorted(chat_format.turns(held).collect(), key=key)
    assert sorted(chat_format.turns(held, slice_turns=4).collect(), key=key) == whole
    formatted = {r.conv_id: r.formatted for r in chat_format.conversations(held).collect()}
    for r in whole:
        assert formatted[r.conv_id][r.start :].startswith("".join(s.text for s in r.segments))
    assert [r.allowed for r in whole] == [True] * 23 + [True, False, False]


def test_templates_that_could_not_be_read_back_are_refused(spark):
    good = chat_format.INSTRUCTIONS
    marks = chat_format.Marks
    for roles, control in (
        ({"user": marks("[INST] ", " end")}, good.control),  # no control string after the text
        ({"user": marks("[INST] ", "</s>"), "assistant": marks("[INST] a", "</s>")}, good.control),  # one begins the other
        ({"user": marks("<", "</s>")}, good.control),  # with a text "s>" a control string
        ({"user": marks("u:", "\\</s>")}, good.control),
    ):
        with pytest.raises(ValueError):
            chat_format.Template(roles, good.other, good.follows, good.ends, control)
    assert chat_format.conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
