"""Slow, plain statements of the operators' meaning, to compare with."""

import random
import re


def chunks(text, size, overlap, cap=True):
    text, quarter = text.strip(), size // 4
    if len(text) <= size:
        return [text]
    found, start, steps = [], 0, 0
    while start < len(text) and (not cap or steps < len(text) // max(1, quarter)):
        steps += 1
        window = text[start : start + size]
        if start + size >= len(text):
            cut = len(window)
        else:
            cut = len(window)
            # Shortest possible pattern at every place, instead of one pass over matches.
            ends = [e for e in range(2, len(window) + 1) if re.search(r"[.!?]\s+\Z", window[:e])]
            ends = [e for e in ends if e == len(window) or not window[e].isspace()]
            if ends:
                cut = max(ends) if max(ends) >= quarter else cut
            elif window.rfind("\n\n") > quarter:
                cut = window.rfind("\n\n") + 2
            elif window.rfind("\n") > quarter:
                cut = window.rfind("\n") + 1
        if window[:cut].strip():
            found.append(window[:cut].strip())
        if start + cut >= len(text):
            break
        start = start + cut - overlap if cut > overlap else start + max(1, size // 2)
    return found


def line_chunks(text, size, overlap):
    text = text.strip()
    if len(text) <= size:
        return [text]
    found, start = [], 0
    while True:
        window = text[start : start + size]
        at_end = start + size >= len(text)
        newline = window.rfind("\n")
        cut = newline if not at_end and newline > size // 4 else len(window)
        found.append(window[:cut].strip())
        if start + cut >= len(text):
            return found
        start = max(start + cut - overlap, start + 1)


def sentences(text):
    parts = [part.strip() for part in re.split(r"[.!?]+", re.sub(r"\s+", " ", text))]
    return [part for part in parts if len(part.lower()) >= 10]


def similar(a, b):
    a, b = set(a.lower().split()), set(b.lower().split())
    return len(a & b) / len(a | b) > 0.7


def greedy(items):
    kept = []
    for item in items:
        if not any(similar(item, other) for other in kept):
            kept.append(item)
    return kept


def dedup(text):
    kept = greedy(sentences(text))
    return ". ".join(kept) + ("." if kept else "")


def random_text(rng: random.Random, length: int) -> str:
    pieces = ["a", "bc", "word", "long words here", ". ", "! ", "?", ".. ", "\n", "\n\n", " ", "  ", "é", "\t", "\xa0", " "]
    text = ""
    while len(text) < length:
        text += rng.choice(pieces)
    return text


def random_sentences(rng: random.Random, count: int, words: int = 30) -> list[str]:
    vocabulary = [f"word{i}" for i in range(words)]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(1, 9))) for _ in range(count)]
