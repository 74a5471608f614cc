"""Quality rules: which rows are clean, and why the others are not.

A row is judged in two steps. Every checked field is cast first, so one uncastable
value makes the row `2` whatever the others hold. Then the range rules run in their
order and the first that fails decides: a missing value gives `2`, a value out of
range gives `1`. The rules are turned into one SQL expression each.
"""

from __future__ import annotations

from dataclasses import dataclass

from tonearm.functions.casting import is_missing, lenient, uncastable

# Fixed values of `dirty_type`.
OUT_OF_RANGE = "1"
UNCASTABLE_OR_MISSING = "2"


@dataclass(frozen=True)
class Rule:
    """`0 < field` (and `< below`) on a number, or mere presence of a text. With `only`,
    an SQL condition, the rule is for the rows that meet it."""

    field: str
    type_name: str = "bigint"
    below: int | None = None
    present_only: bool = False
    only: str | None = None

    def leaf(self, body: str) -> str:
        return f"{body}.{self.field}" if body else self.field

    def _applies(self, test: str) -> str:
        return f"({self.only} AND {test})" if self.only else test

    def holds(self, body: str) -> str:
        """True for a good value, false or null otherwise."""
        if self.present_only:
            test = f"({self.leaf(body)} IS NOT NULL)"
        else:
            number = lenient(self.leaf(body), self.type_name)
            upper = f"BETWEEN 1 AND {self.below - 1}" if self.below is not None else "> 0"
            test = f"({number} {upper})"
        return f"(NOT {self.only} OR {test})" if self.only else test

    def cast_fails(self, body: str) -> str:
        return self._applies(uncastable(self.leaf(body), self.type_name))

    def missing(self, body: str) -> str:
        return self._applies(is_missing(self.leaf(body)))


def province(field: str = "province_id") -> Rule:
    return Rule(field, type_name="int", below=35)


def is_clean(rules: list[Rule], body: str) -> str:
    """Whether all rules hold. Casts each field once, and a value that is missing or
    uncastable fails like one out of range, so this is the cheap test for most rows."""
    return "coalesce(" + " AND ".join(r.holds(body) for r in rules) + ", false)"


def dirty_type(rules: list[Rule], body: str) -> str:
    """`dirty_type` of a row, null when it is clean."""
    failed = " OR ".join(r.cast_fails(body) for r in rules if not r.present_only)
    cases = [f"WHEN {failed} THEN '{UNCASTABLE_OR_MISSING}'"]
    for rule in rules:
        if not rule.present_only:
            cases.append(f"WHEN {rule.missing(body)} THEN '{UNCASTABLE_OR_MISSING}'")
        cases.append(f"WHEN NOT {rule.holds(body)} THEN '{OUT_OF_RANGE}'")
    return "CASE " + " ".join(cases) + " END"
