"""Noisy-channel restoring of obfuscated words.

A written word is taken as an intended word sent through a channel that swaps
letters for look-alikes, stretches letters, puts signs or spaces between them.
The lattice holds, for every written character, the letters it may stand for or
nothing; a Viterbi search under a character trigram model picks the path.
"""

from __future__ import annotations

import re
from math import log

import numpy as np

# The letters that a sign or digit may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
    "*": "aeiou", "#": "h", "%": "x", "&": "a",
}

# Channel: log chances of a letter meant as written, a look-alike, a sign that
# stands for nothing, a digit that does, one more letter of a stretch, and of a
# word break between spaced letters.
PLAIN, SWAPPED, SIGN, DIGIT, STRETCH, BREAK = log(0.95), log(0.2), log(0.05), log(0.002), log(0.3), log(0.05)

# classes of the model: 0 word break, 1 to 26 letters, 27 any other letter
CLASSES = 28

_EDGE = re.compile(r"^[\"'(\[{.,;:?]+|(?:([#*$%&|<>!])\1+|[.,;:?!)\]}\"'%#&*|<>])+$")
_LETTER = re.compile(r"[^\W\d_]")
_ODD = re.compile(r"[^\w]|\d|_")
_RUN = re.compile(r"(.)\1\1+")


def letter_class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27


def byte_classes() -> np.ndarray:
    """Class by byte of a UTF-8 text: bytes of other scripts count as other letters."""
    table = np.zeros(256, np.int64)
    table[97:123] = table[65:91] = np.arange(1, 27)
    table[128:] = 27
    return table


class CharacterModel:
    """Trigram model from counts of three classes in a row, interpolated with the
    bigram and unigram models."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(CLASSES, CLASSES, CLASSES).astype(float)
        two = c.sum(axis=0)
        one = two.sum(axis=0) + 1
        uni = one / one.sum()
        bi = (two + 5 * uni) / (two.sum(axis=1, keepdims=True) + 5)
        tri = (c + 5 * bi) / (c.sum(axis=2, keepdims=True) + 5)
        # at a word's start the letter before the break doesn't matter
        tri[:, 0, :] = bi[0]
        self.table = np.log(tri).tolist()


def edge_free(word: str) -> str:
    return _EDGE.sub("", word)


def suspicious(word: str) -> bool:
    """Whether the channel may have changed the word: signs or digits among
    letters, or a letter three times in a row."""
    if not _LETTER.search(word) and not any(c in "$@!*" for c in word):
        return False
    return bool(_ODD.search(word) or _RUN.search(word))


def decode(word: str, model: CharacterModel, spaced: bool = False) -> tuple[float, str]:
    """Log probability and text of the likeliest intended letters of a lower-case
    written word (without spaces), stretches shortened first; ``spaced`` allows
    word breaks. Viterbi over the classes of the last two letters; a state holds
    its letters as a chain, so the time grows with the word's length only.
    """
    short = _RUN.sub(r"\1\1", word)
    table = model.table
    # state: classes of the last two letters -> (score, (chain before, letter))
    states: dict = {(0, 0): (0.0, None)}
    before = ""
    for c in short:
        plain = _LETTER.match(c) is not None
        if plain:
            choices = [(c, PLAIN)]
        else:
            choices = [(x, SWAPPED - log(len(LOOKALIKES[c]))) for x in LOOKALIKES.get(c, "")]
        choices = [(x, letter_class(x), p) for x, p in choices]
        skip = None if plain else DIGIT if c.isdigit() else SIGN
        new: dict = {}

        def better(state, score):
            return state not in new or score > new[state][0]

        for (a, b), (score, chain) in states.items():
            row = table[a][b]
            for x, k, p in choices:
                s = score + p + row[k]
                if better((b, k), s):
                    new[(b, k)] = (s, (chain, x))
                if spaced and b:
                    s = score + p + BREAK + row[0] + table[b][0][k]
                    if better((0, k), s):
                        new[(0, k)] = (s, (chain, " " + x))
                if chain and chain[1][-1] == x and c == before and better((a, b), score + STRETCH):
                    new[(a, b)] = (score + STRETCH, chain)
            if skip is not None and better((a, b), score + skip):
                new[(a, b)] = (score + skip, chain)
        states, before = new or states, c
    score, _, chain = max(((s + table[a][b][0], (a, b), chain) for (a, b), (s, chain) in states.items()),
                          key=lambda x: x[:2])
    letters = []
    while chain:
        chain, x = chain
        letters.append(x)
    return score, "".join(reversed(letters))


def restore(word: str, model: CharacterModel, spaced: bool = False) -> list[str]:
    """The likeliest intended words; more than one only with ``spaced``."""
    return decode(word, model, spaced)[1].split()
