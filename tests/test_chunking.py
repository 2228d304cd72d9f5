import random

import pytest

from corpusloom.functions.chunking import chunk_text
from tests import brute_force


@pytest.mark.parametrize(("size", "overlap"), [(50, 10), (40, 39), (25, 20), (7, 3), (3, 1), (50, 200)])
def test_matches_brute_force(evaluate, size, overlap):
    rng = random.Random(size)
    texts = [brute_force.random_text(rng, rng.randint(0, 400)) for _ in range(150)]
    assert evaluate(texts, lambda c: chunk_text(c, size, overlap, step_cap=True)) == [
        brute_force.chunks(text, size, overlap) for text in texts
    ]


@pytest.mark.parametrize(("size", "overlap"), [(50, 10), (25, 20), (7, 3)])
def test_matches_brute_force_without_cap_and_by_line(evaluate, size, overlap):
    rng = random.Random(size + 1)
    texts = [brute_force.random_text(rng, rng.randint(0, 300)) for _ in range(100)]
    assert evaluate(texts, lambda c: chunk_text(c, size, overlap, step_cap=False)) == [
        brute_force.chunks(text, size, overlap, cap=False) for text in texts
    ]
    assert evaluate(texts, lambda c: chunk_text(c, size, overlap, sentence_aware=False)) == [
        brute_force.line_chunks(text, size, overlap) for text in texts
    ]


def test_uncapped_chunks_end_with_the_text(evaluate):
    text = " ".join(f"Sentence number {i} is here." for i in range(400))
    [chunks] = evaluate([text], lambda c: chunk_text(c, 250, 200, step_cap=False))
    assert text.endswith(chunks[-1])


def test_plain_cases(evaluate):
    texts = ["A" * 100, "A" * 1000 + "B" * 1000, "A" * 50, "", None]
    by_size = evaluate(texts, lambda c: chunk_text(c, 50, 10))
    assert [len(chunk) for chunk in by_size[0]] == [50, 50, 20]
    assert by_size[3] == [""]
    assert by_size[2] == ["A" * 50]
    overlapping = evaluate(texts[1:2], lambda c: chunk_text(c, 800, 100))[0]
    assert overlapping[1][:100] == overlapping[0][-100:]
