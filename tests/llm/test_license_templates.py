"""Whole license templates: every clause is mandatory, every marked region optional, and the automata agree with regular expressions."""

from __future__ import annotations

import random
import re

import pytest

from starloom.llm import licenses

MARKS = re.compile(r"\[\[|\]\]|\{\{(\d+)\}\}|[^\s\[\]{}]+")


def pattern(template: str) -> re.Pattern:
    """The template as a regular expression over words that each end with a space."""
    out = []
    for m in MARKS.finditer(template):
        out.append("(?:" if m[0] == "[[" else ")?" if m[0] == "]]" else rf"(?:\S+ ){{0,{m[1]}}}" if m[1] else re.escape(m[0]) + " ")
    return re.compile("".join(out))


def variants(template: str, with_optional: bool, filler: str = "the authors") -> list[str]:
    """The template's words with its optional regions or without; up to two words stand for a replaceable region."""
    out, depth = [], 0
    for m in MARKS.finditer(template):
        if m[0] == "[[":
            depth += 1
        elif m[0] == "]]":
            depth -= 1
        elif depth and not with_optional:
            continue
        elif m[1]:
            out += filler.split()[:int(m[1])]
        else:
            out.append(m[0])
    return out


def labels(text: str) -> set[str]:
    return {label for label, base, _, _ in licenses.scan_text(text, licenses.compiled(base={}))[1] if not base}


@pytest.mark.parametrize("label", sorted(licenses.TEMPLATES))
def test_whole_wording_is_found_with_and_without_optional_parts(label):
    for with_optional in (True, False):
        text = " ".join(variants(licenses.TEMPLATES[label], with_optional))
        assert label in labels(f"Before it. {text.upper()}, and after")
        assert label in labels(text.replace(" ", "\n * "))


@pytest.mark.parametrize("label", sorted(licenses.LICENSES))
def test_a_missing_or_changed_clause_is_refused(label):
    words = variants(licenses.LICENSES[label], False, "")  # mandatory words only
    whole = " ".join(words)
    assert label in labels(whole)
    for at in range(0, len(words), 7):
        for changed in (words[:at] + words[at + 7:], words[:at] + ["otherwise"] + words[at + 1:], words[:at]):
            assert label not in labels(" ".join(changed)), (label, at)
    assert label not in labels(" ".join(words[:40]) + " shall be used for good not evil")


def test_grants_with_other_conditions_are_no_mit():
    grant = licenses.LICENSES["mit-text"].split("the above copyright")[0]
    text = " ".join(variants(grant, True)) + " The Software shall be used for Good, not Evil. You must pay us."
    assert not labels(text)


def test_two_and_three_clauses_are_told_apart():
    two, three = (" ".join(variants(licenses.LICENSES[f"bsd-{k}-text"], True)) for k in (2, 3))
    assert labels(two) == {"bsd-2-text"} and labels(three) == {"bsd-3-text"}


@pytest.mark.parametrize("label", sorted(licenses.TEMPLATES))
def test_automata_agree_with_regular_expressions(label):
    template, rng = licenses.TEMPLATES[label], random.Random(label)
    automaton, expected = licenses.compile_template(label, template), pattern(template)
    for _ in range(60):
        words = variants(template, rng.random() < .5, rng.choice(["", "x", "one two three four"]))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = rng.choice([[], ["x"], [words[at]], ["x", "y"]])
        line = "".join(w + " " for w in words)
        starts = [0, *(m.end() for m in re.finditer(" ", line))][:-1]
        spans = []
        for k, at in enumerate(starts):
            m = expected.match(line, at)
            if m and m.end() > at:
                spans.append((k, k + m[0].count(" ")))
        found = [(start, end) for name, _, start, end in licenses.scan_text(line, [automaton])[1]]
        assert [s for s, _ in found] == [s for s, _ in spans]
        assert all(end >= e for (_, end), (_, e) in zip(found, spans))  # the longest match, an expression may stop sooner
