"""Plain Python forms of what the operators compute."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text, size=5):
    found = words(text)
    if len(found) < size:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def prose(random, n, vocabulary=400):
    return " ".join(f"w{random.integers(vocabulary)}" for _ in range(n))
