"""Fingerprints against a parser written name by name, and the order of documents by hand."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from starmart.llm import fingerprints
from starmart.llm.fingerprints import (
    compare_with_next,
    fingerprint,
    likeness,
    parse_levels,
    read_fingerprints,
    sketch,
)

_ALL = (1 << 64) - 1


def _mix(x):
    x = (x ^ (x >> 32)) * int(fingerprints._MIX) & _ALL
    x = (x ^ (x >> 29)) * int(fingerprints._RUN) & _ALL
    return x ^ (x >> 32)


def _toss(symbols, before):
    """Twice the lowest differing bit plus that bit, each against the one on its left."""
    tossed = []
    for left, own in zip([before, *symbols], symbols):
        place = ((left ^ own) & -(left ^ own)).bit_length() - 1
        tossed.append(2 * place + (own >> place & 1))
    return tossed


def _levels(text):
    """All levels of one text, one name after the other."""
    names = [_mix(ord(c) + 1) for c in text]
    levels = [names]
    while len(names) > 1:
        runs = []
        for name in names:
            if runs and runs[-1][0] == name:
                runs[-1][1] += 1
            else:
                runs.append([name, 1])
        names = [n if k == 1 else _mix((n + k * int(fingerprints._RUN)) & _ALL) for n, k in runs]
        labels = _toss(names, 0)
        for _ in range(3):
            labels = _toss(labels, labels[0] ^ 1)
        assert max(labels) < 6
        begins = [0] + [
            i for i in range(1, len(names) - 1) if labels[i - 1] < labels[i] > labels[i + 1]
        ]
        radix, phrases = int(fingerprints._RADIX), []
        for low, high in zip(begins, [*begins[1:], len(names)]):
            total = sum(n * pow(radix, i, 1 << 64) for i, n in enumerate(names[low:high]))
            phrases.append(_mix(total & _ALL))
        names = phrases
        levels.append(names)
    return levels


def _parsed(texts):
    found = [[] for _ in texts]
    for numbers, starts, names in parse_levels(texts):
        for number, part in zip(numbers, np.split(names, starts[1:])):
            found[number].append(part.tolist())
    return found


LONG = "".join(f"Word {i * i % 977} and Ωmega {i}. " for i in range(400))


def test_parses_like_one_name_after_the_other():
    texts = ["a", "ab", "abc", "aaaa", "aaaabaaaa", "", "abababababab", "😀é" * 9 + "x", LONG, "  \n"]
    assert _parsed(texts) == [_levels(text) if text else [] for text in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab c😀", max_size=60), min_size=1, max_size=5))
def test_neighbours_in_a_batch_change_nothing(texts):
    assert _parsed(texts) == [_levels(text) if text else [] for text in texts]


def test_equal_substrings_share_interior_names_at_any_offset():
    a, b = _parsed(["Something before: " + LONG + " the end", "x" * 7 + LONG * 1 + "Other ends!"])
    for level in (1, 2, 3, 4):
        own = _parsed([LONG])[0][level]
        # All but the few phrases at the two ends.
        for other in (a, b):
            shared = set(own) & set(other[level])
            assert len(set(own) - shared) <= 8, level


def test_likeness_follows_the_share_of_common_text():
    other = "".join(f"Nothing {i * 31 % 1009} alike here, {i}! " for i in range(400))
    texts = [LONG, LONG[: len(LONG) // 2] + other[: len(LONG) // 2], other]
    half, none, whole = (
        likeness(sketch([LONG]), sketch([text]))[0] for text in (texts[1], texts[2], LONG)
    )
    assert whole == 1
    assert 0.15 < half < 0.6
    assert none < 0.1


def _docs(spark, rows):
    return spark.createDataFrame(
        [(*row, 1, "x") for row in rows], "doc_id long, text string, part int, kind string"
    )


def _brute(rows):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    found = []
    for at, (doc_id, text) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        cut = len(text) // 4
        changed = text[: len(text) - cut] + following[:cut]
        own, after, other = (sketch([t]) for t in (text, following, changed))
        prints = [fingerprints.packed(*p)[0].hex() for p in (own, other)]
        digest = sha256(changed.encode()).hexdigest()
        near = (float(likeness(own, p)[0]) for p in (other, after))
        found.append((doc_id, len(text), digest, *prints, *near))
    return sorted(found, key=repr)


def _found(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("slice_chars", [50, 1 << 20])
def test_equals_documents_in_order(spark, monkeypatch, slice_chars, conf):
    monkeypatch.setattr(fingerprints, "_SLICE_CHARS", slice_chars)
    conf(adaptive__coalescePartitions__enabled="false")
    rows = [(i * 37 % 101, LONG[i * 7 : i * 7 + i * 5]) for i in range(101)]
    rows += [(None, "No id"), (200, None), (201, ""), (202, "ÄÖ😀 " * 30), (203, LONG * 20)]
    assert _found(compare_with_next(_docs(spark, rows))) == _brute(rows)


@pytest.mark.parametrize("rows", [[], [(4, "alone with itself")], [(1, None), (1, "")]])
def test_few_rows(spark, rows):
    assert _found(compare_with_next(_docs(spark, rows))) == _brute(rows)


def test_a_hot_id_with_repeated_rows(spark):
    rows = [(5, f"copy {i % 3}") for i in range(90)] + [(6, "last")]
    found = _found(compare_with_next(_docs(spark, rows)))
    prints = {i: fingerprints.packed(*sketch([f"copy {i}"]))[0].hex() for i in range(3)}
    assert [sum(r[3] == p for r in found) for p in prints.values()] == [30, 30, 30]
    # Equal texts stand together: two in three are followed by an equal text.
    assert sum(r[6] == 1 for r in found) == 87


def test_fingerprints_can_be_read_back(spark):
    docs = _docs(spark, [(1, LONG), (2, LONG), (3, None), (4, LONG[:900])])
    found = dict(fingerprint(docs).collect())
    assert found[1] == found[2] != found[4]
    a, b = (read_fingerprints([found[i]]) for i in (1, 4))
    assert likeness(a, b)[0] == likeness(sketch([LONG]), sketch([LONG[:900]]))[0]
