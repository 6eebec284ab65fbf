"""Suffix stemming as one Spark SQL expression, so tokens never leave the JVM.

The rules look at the word as vowels and consonants. A ``y`` is a vowel exactly when the letter
after it is a consonant, which makes all conditions on a stem plain regular expressions:

* some vowel: one of aeiou, or a y before anything but aeiou;
* some vowel followed by a consonant: one of aeiouy before anything but aeiou;
* consonant, vowel other than y, consonant at the end.

Only the number of vowel-consonant steps needs the y's resolved first.

The expression is assembled as SQL text: a few hundred nodes parse in a moment, while building
them one Column call at a time takes longer than many queries run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes and what replaces them, in the order they are tried.
PLURALS = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
PARTICIPLES = ["ed", "ing"]
AFTER_PARTICIPLE = [("at", "ate"), ("bl", "ble"), ("iz", "ize")]
DOUBLE_SUFFIXES = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
SINGLE_SUFFIXES = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
ENDINGS = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

_SOME_VOWEL = r"[aeiou]|y[^aeiou]"
_SOME_STEP = r"[aeiouy][^aeiou]"
_STEP = r"[aeiou][^aeiou]"
# A y is a vowel if an even run of y's and a hard consonant follow, or an odd run and a vowel or
# the end.
_VOWEL_Y = r"y(?=(?:yy)*+[^aeiouy])|y(?=y(?:yy)*+(?:[aeiou]|\z))"
# A character beyond the basic plane counts as two consonants.
_CVC_END = r"[^aeiou][aeiou][^aeiou\x{10000}-\x{10FFFF}]\z"
_DOUBLE_END = r"([^aeiou\x{10000}-\x{10FFFF}])\1\z"

Condition = Callable[[str], str]


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _matches(word: str, pattern: str) -> str:
    return f"{word} RLIKE r'{pattern}'"


def _ends(word: str, suffix: str) -> str:
    return f"endswith({word}, '{suffix}')"


def _cut(word: str, letters: int) -> str:
    return f"left({word}, length({word}) - {letters})"


def _has_vowel(stem: str) -> str:
    return _matches(stem, _SOME_VOWEL)


def _measure(stem: str) -> str:
    """Number of vowel-consonant steps."""
    resolved = f"if(contains({stem}, 'y'), regexp_replace({stem}, r'{_VOWEL_Y}', 'a'), {stem})"
    return f"regexp_count({resolved}, r'{_STEP}')"


def _m_over_0(stem: str) -> str:
    return _matches(stem, _SOME_STEP)


def _m_over_1(stem: str) -> str:
    # Every step takes two letters, so short stems need no count.
    return f"(length({stem}) > 3 AND {_measure(stem)} > 1)"


def _replace_first(rules: Iterable[tuple[str, str, Condition | None]]) -> str:
    """Apply to ``w`` the first rule whose suffix and condition on the rest both hold.

    Most words end like none of the rules; one look at the last letters spares them the list.
    """
    rules = list(rules)
    known = min([2] + [len(suffix) for suffix, _, _ in rules])
    last = ", ".join(f"'{e}'" for e in sorted({suffix[-known:] for suffix, _, _ in rules}))
    cases = [f"WHEN right(w, {known}) NOT IN ({last}) THEN w"]
    for suffix, replacement, condition in rules:
        rest = _cut("w", len(suffix))
        test = _ends("w", suffix) + (f" AND {condition(rest)}" if condition else "")
        cases.append(f"WHEN {test} THEN " + (f"{rest} || '{replacement}'" if replacement else rest))
    return f"CASE {' '.join(cases)} ELSE w END"


def _participle() -> str:
    stripped = " ".join(
        f"WHEN {_ends('w', s)} AND {_has_vowel(_cut('w', len(s)))} THEN {_cut('w', len(s))}"
        for s in PARTICIPLES
    )
    untouched = _replace_first([("eed", "ee", _m_over_0)])
    repaired = _let("c", f"CASE {stripped} END", f"if(c IS NULL, {untouched}, {_repair('c')})")
    return f"if(right(w, 1) IN ('d', 'g'), {repaired}, w)"


def _repair(stem: str) -> str:
    completed = " ".join(
        f"WHEN {_ends(stem, s)} THEN {_cut(stem, len(s))} || '{r}'" for s, r in AFTER_PARTICIPLE
    )
    return (
        f"CASE {completed} "
        f"WHEN {_matches(stem, _DOUBLE_END)} AND right({stem}, 1) NOT IN ('l', 's', 'z') "
        f"THEN {_cut(stem, 1)} "
        f"WHEN {_matches(stem, _CVC_END)} AND {_measure(stem)} = 1 THEN {stem} || 'e' "
        f"ELSE {stem} END"
    )


def _ending_condition(suffix: str) -> Condition:
    if suffix == "ion":
        return lambda rest: f"right({rest}, 1) IN ('s', 't') AND {_m_over_1(rest)}"
    return _m_over_1


def _drops_final_e(rest: str) -> str:
    return _let("m", _measure(rest), f"m > 1 OR (m = 1 AND NOT {_matches(rest, _CVC_END)})")


_STEPS = (
    "lower(w)",
    _replace_first([(s, r, None) for s, r in PLURALS]),
    _participle(),
    _replace_first([("y", "i", _has_vowel)]),
    _replace_first([(s, r, _m_over_0) for s, r in DOUBLE_SUFFIXES]),
    _replace_first([(s, r, _m_over_0) for s, r in SINGLE_SUFFIXES]),
    _replace_first([(s, "", _ending_condition(s)) for s in ENDINGS]),
    _replace_first([("e", "", _drops_final_e)]),
    f"if({_ends('w', 'll')} AND {_m_over_1('w')}, {_cut('w', 1)}, w)",
)


def _stemmed(items: str) -> str:
    for step in _STEPS:
        items = f"transform({items}, w -> {step})"
    return items


def stem_all(column: str) -> Column:
    """Stem every token of the named array column, one pass per step."""
    return F.expr(_stemmed(f"`{column}`"))


def stem(column: str) -> Column:
    """Stem the word in the named column."""
    return F.expr(f"{_stemmed(f'array(`{column}`)')}[0]")
