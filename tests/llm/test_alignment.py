"""Cross-tokenizer alignment, against a plain version with the ``tokenizers`` library."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pytest

from tests_llm_helpers import corpus, frame, ready  # noqa: F401
from titlepulse.llm import token_alignment as ta
from titlepulse.llm.packing import tokenizer_path


def plain_tokens(text):
    """Ids with their byte ranges of both sides, or None."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ta.piece_path())
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(n): n for n in printable} | {chr(256 + k): n for k, n in enumerate(n for n in range(256) if n not in printable)}
    data = (" " + text).encode()
    sides = []
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(byte_of[c] for c in a.id_to_token(n)) for n in a_ids]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(n) else p.replace("▁", " ").encode() for n in b_ids for p in [b.id_to_piece(n)]]
    for ids, parts in ((a_ids, a_bytes), (b_ids, b_bytes)):
        if b"".join(parts) != data:
            return None
        ends = list(itertools.accumulate(map(len, parts)))
        sides.append([(n, end - len(part), end) for n, part, end in zip(ids, parts, ends)])
    return sides


def plain_alignment(rows):
    held, counts = [], Counter()
    for doc_id, text in rows:
        sides = plain_tokens(text) if text else None
        if sides is None:
            held.append((doc_id, None))
            continue
        a, b = sides
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 3000 else None
        common = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, i, j = [], 0, 0
        for end in common:
            ga, gb = [], []
            while i < len(a) and a[i][2] <= end:
                ga.append(a[i]), (i := i + 1)
            while j < len(b) and b[j][2] <= end:
                gb.append(b[j]), (j := j + 1)
            groups.append((ga, gb))
        if links is None:
            links = [(x[0], y[0]) for ga, gb in groups for x in ga for y in gb if x[1] < y[2] and y[1] < x[2]]
        counts.update(links)
        held.append((doc_id, (a, b, groups, links)))
    highest = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for doc_id, own in held:
        if own is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = own
        text = ";".join(",".join(str(x[0]) for x in ga) + "|" + ",".join(str(y[0]) for y in gb) for ga, gb in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[k] == highest[k[1]] for k in links), sum(counts[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


def texts():
    rng = random.Random(11)
    odd = ["<|endoftext|> a", "</s> <s>x", "日本語のテキスト。" * 9, "naïve café ▁ mark", "▁", " ", "  two  blanks  ", "a\x00b", "é" * 40, "𝄞𝄞 𝄞", "ﬁ x　", "\t\n\r\n", "don't it's we'll", "1234567 12 3", "́́"]
    rows = [(n, t) for n, t in corpus(8, docs=25) if n is None or n < 32] + [(100 + n, t) for n, t in enumerate(odd)]
    rows += [(200, " ".join(rng.choice(["word", "ünï", "x1", "  ", "日本", "</s>", "don't"]) for _ in range(900)))]
    return rows + [(201, "x" * 700 + " y"), (202, "日本語" * 200), (203, "word " * 300 + "▁ end")]


def result(df):
    return sorted(map(tuple, df.select("doc_id", *ta._NUMBERS, "groups_sha256").collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("bounds", [{}, {"segment_chars": 64, "range_bytes": 16}, {"range_bytes": 7, "cached_pairs": 40}, {"segment_chars": 200, "cached_pairs": 0}])
def test_alignment_equals_brute_force(frame, bounds):
    rows = texts()
    found = result(ta.documents(ta.align(frame(rows), **bounds)))
    assert found == sorted(plain_alignment(rows), key=lambda r: (r[0] is None, r))


def test_groups_hold_all_tokens(frame):
    rows = [(1, "alignment of tokens, naïve and tokenised 日本語"), (2, None)]
    (run,) = ta.align(frame(rows)).groups().collect()
    a, b = plain_tokens(rows[0][1])
    assert run.a_ids == [x[0] for x in a] and run.b_ids == [y[0] for y in b]
    assert sum(run.a_sizes) == len(a) and sum(run.b_sizes) == len(b) and len(run.a_sizes) == len(run.b_sizes)


def test_fragments_compose_in_any_order():
    rng = random.Random(2)
    for _ in range(200):
        size = rng.randint(1, 40)
        a_ends, b_ends = (np.array(sorted({*rng.sample(range(1, size + 1), rng.randint(1, size)), size})) for _ in range(2))
        a, b = np.arange(len(a_ends)), np.arange(len(b_ends)) + 100
        edges = sorted({0, size, *rng.sample(range(size + 1), min(size, rng.randint(0, 6)))})
        parts, inside = [], {}
        for low, high in zip(edges, edges[1:]):
            ina, inb = (a_ends > low) & (a_ends <= high), (b_ends > low) & (b_ends <= high)
            fragment, closed = ta.fragment_of(low, low == 0, a[ina], b[inb], a_ends[ina], b_ends[inb])
            parts.append(fragment)
            inside[low] = tuple(tuple(x.tolist()) for x in closed)

        def tree(own):
            cut = rng.randint(1, len(own) - 1) if len(own) > 1 else 0
            return tree(own[:cut]) + tree(own[cut:]) if cut else own[0]

        whole = reduce(lambda x, y: x + y, parts)
        assert all(tree(parts) == whole for _ in range(5))
        # Every token is in exactly one closed group, and nothing stays open at the end of the document.
        assert whole.cut and whole.prefix == whole.suffix == ta.NONE
        places = sorted([(place, 0, tokens) for place, tokens in whole.closed] + [(place, 1, tokens) for place, tokens in inside.items()])
        assert [n for _, _, (x, _) in places for n in x] == a.tolist() and [n for _, _, (_, y) in places for n in y] == b.tolist()


def test_segments_give_the_ids_of_the_whole_text():
    own = ta.vocabularies(tokenizer_path(), ta.piece_path())
    assert own.separable
    rng = random.Random(5)
    bits = ["word", " ", "  ", "\n", " \t", "'s", " don't", "12", ".", "…", "日本", "é", "▁", " ", "​", "𝄞", "Ǆ", "<s>", "́", "-"]
    cuts = 0
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(120))
        parts = list(ta.segments_of(text, 10, True))
        assert "".join(parts) == " " + text
        cuts += len(parts) - 1
        assert [n for p in parts for n in own.a.encode_ordinary(p)] == own.a.encode_ordinary(" " + text)
        assert [n for p in parts for n in own.b.encode(p[1:])] == own.b.encode(text)
    assert cuts > 300


def test_alignment_of_no_rows(frame):
    assert ta.documents(ta.align(frame([]))).collect() == []
    assert result(ta.documents(ta.align(frame([(1, None), (1, None), (2, "")])))) == [(1, 0, 0, 0, 0, 0, 0, "")] * 2 + [(2, 0, 0, 0, 0, 0, 0, "")]
