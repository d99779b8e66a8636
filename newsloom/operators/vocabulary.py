"""Vocabularies and the regular expressions that Spark gets from them.

A vocabulary is always a parameter. Its terms become one literal pattern, longest first, so that a task compiles it once.
Java patterns carry (?U): without it, letters beyond ASCII would not count as word characters.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from dataclasses import dataclass

_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}\-&#~])")


def quote(term: str) -> str:
    return _SPECIAL.sub(r"\\\1", term)


def _branches(terms: list[str]) -> str:
    """The terms as one pattern that tries the longest first, with what they begin alike in common.

    All terms that match at a place begin one another, so that going on before stopping finds the longest.
    """
    if len(terms) == 1:
        return quote(terms[0])
    by_first: dict[str, list[str]] = {}
    for t in terms:
        by_first.setdefault(t[:1], []).append(t)
    stops = by_first.pop("", None) is not None
    out = []
    for own in by_first.values():
        n = len(os.path.commonprefix(own))
        out.append(quote(own[0][:n]) + (_branches([t[n:] for t in own]) if len(own) > 1 else quote(own[0][n:])))
    if not out:
        return ""
    return "(?:" + "|".join(out) + ")" + ("?" if stops else "")


def _first_letters(terms: list[str]) -> str:
    """A look at the next character, which sorts out most places of a text at once."""
    return "(?=[" + "".join(sorted({quote(t[0]) for t in terms})) + "])"


def lowered(term: str) -> str:
    return " ".join(term.lower().split())


def _in_words(c: str) -> bool:
    """Whether Java counts a character to words for certain; the scripts beyond differ by version of Unicode."""
    return c == "_" or (ord(c) < 0x860 and (c.isalpha() or c.isdecimal()))


def head(term: str) -> str | None:
    """The whole word that a text with the term has where the term begins; None if that is not certain."""
    n = next((i for i, c in enumerate(term) if not _in_words(c)), len(term))
    return term[:n] if n and (n == len(term) or term[n].isascii()) else None


@dataclass(frozen=True)
class TermSet:
    """Named terms in order, repeats included."""

    name: str
    terms: tuple[str, ...]

    @staticmethod
    def of(name: str, terms: Iterable[str]) -> "TermSet":
        return TermSet(name, tuple(lowered(t) for t in terms))

    @property
    def whole_words(self) -> str:
        """Any term between characters that are no word characters; the longest first, so that it shadows those within it."""
        own = list(dict.fromkeys(t for t in self.terms if t))
        return r"(?U)" + _first_letters(own) + r"(?<!\w)(?:" + _branches(own) + r")(?!\w)" if own else r"(?!)"

    @property
    def stems(self) -> str:
        """Any term from a word's start; to the word's end too if its last character is an ASCII letter."""
        terms = list(dict.fromkeys(t for t in self.terms if t))
        own = [quote(t) + (r"(?!\w)" if t[-1].isascii() and t[-1].isalpha() else "") for t in terms]
        return r"(?U)" + _first_letters(terms) + r"(?<!\w)(?:" + "|".join(sorted(own, key=len, reverse=True)) + ")" if own else r"(?!)"

    @property
    def heads(self) -> list[str] | None:
        """The first words of all terms, of which a text with a term has one; None if some term is without."""
        own = [head(t) for t in self.terms if t]
        return None if None in own else list(dict.fromkeys(own))

    @property
    def stem_heads(self) -> list[str] | None:
        """`heads` for `stems`, where a term that may end within a word has none."""
        bare = any(head(t) == t and not (t[-1].isascii() and t[-1].isalpha()) for t in self.terms if t)
        return None if bare else self.heads

    def containers(self) -> dict[str, list[str]]:
        """For each term, the others of the set that hold it as whole words."""
        return {t: [o for o in self.terms if o != t and re.search(rf"(?<!\w){re.escape(t)}(?!\w)", o)] for t in dict.fromkeys(self.terms)}


@dataclass(frozen=True)
class Stem:
    """A pattern that stands for the term `name`; `language` limits it to texts of that language."""

    name: str
    pattern: str
    language: str | None = None
