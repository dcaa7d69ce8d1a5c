"""Fixtures and inputs of these tests.  Not a conftest: there is one above already, which tests import by that name."""

import random
import re

import pytest

from titlepulse.llm.common import prepare

# Names that operators use inside, as further columns of the input.
CLASHING = ("n", "id", "key", "a", "b", "token", "slot", "kept", "n_words", "host", "length", "rows", "_text", "cluster")


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text[, source]) with further columns of clashing names; any of them may be null."""

    def make(rows, clash=True):
        names = [c for c in CLASHING if clash]
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "en", None if r[1] is None else len(r[1]), *[None if n % 2 else 7 for n, _ in enumerate(names)]) for r in rows]
        fields = ["doc_id long", "text string", "source string", "lang string", "n_chars long", *[f"{c} long" for c in names]]
        return spark.createDataFrame(full, ", ".join(fields))

    return make


def corpus(seed, docs=60, vocabulary=300):
    """Texts that share passages and near copies, with a very long one, ties, white space of all kinds, and empties."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) + ("A" if n % 9 == 0 else "") for n in range(vocabulary)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    passage, common = text(40), text(15)
    rows, base = [], text(80)
    for n in range(docs):
        own = text(rng.randint(0, 90))
        if n % 3 == 0:
            own = own[:10] + passage + own[10:]
        if n % 4 == 0:
            own = common + own
        if n % 5 == 0:
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((n, rng.choice([" ", "\n", "\t ", " \x0b"]).join(own)))
    rows += [(docs, rows[0][1]), (docs + 1, rows[0][1]), (docs + 2, ""), (docs + 3, None), (docs + 4, "  \n"), (docs + 5, " ".join(text(5000)))]
    rows += [rows[3], (None, rows[0][1]), (None, None), (docs + 6, "one two"), (docs + 7, "one two"), (docs + 8, "One  two")]
    return rows


def words(text):
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
