"""The policy grammar as column expressions.

A policy option maps columns to pseudonymization functions: ``col1=f(key1);col2=g(key2)``. All
functions work on a column of option strings (one for each dataset version) and stay inside one
row, so a table of policies of any size is parsed without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the function of a column that is listed without one.
UNDEFINED = "undefined"

POLICY_TYPE = "array<struct<var:string,pseudoFunc:string>>"


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value for use at several places of ``body``, so it is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _non_empty_parts(text: Column, separator: str) -> Column:
    return F.filter(F.transform(F.split(text, separator), _trim), lambda part: part != "")


def declaration(text: Column) -> Column:
    """``STRUCT<name, args>`` of a function declaration; parentheses count as blanks, arguments
    are split on commas, trimmed, and kept when empty."""
    return _let(
        _trim(F.regexp_replace(text, "[()]", " ")), lambda plain: _split_declaration(plain)
    )


def _split_declaration(plain: Column) -> Column:
    blank = F.instr(plain, " ")
    name = F.when(blank == 0, plain).otherwise(F.substring(plain, F.lit(1), blank - 1))
    args = F.when(blank == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.split(F.substring(plain, blank, F.length(plain)), ","), _trim)
    )
    return F.struct(name.alias("name"), args.alias("args"))


def canonical(text: Column) -> Column:
    """Canonical text ``name(arg,arg)`` of a declaration."""
    return _let(
        declaration(text),
        lambda d: F.concat(d["name"], F.lit("("), F.array_join(d["args"], ","), F.lit(")")),
    )


def parse_option(option: Column) -> Column:
    """``ARRAY<STRUCT<var, pseudoFunc>>`` of a policy option, in declaration order.

    Blank mappings are dropped, a bare column gets ``undefined``, a mapping with more than one
    equals sign is ignored. A column listed twice keeps its first place and its last function.
    """
    pairs = F.transform(_non_empty_parts(option, ";"), lambda m: _non_empty_parts(m, "="))
    usable = F.filter(pairs, lambda p: F.size(p).isin(1, 2))
    mappings = F.transform(
        usable,
        lambda p: F.struct(
            p[0].alias("var"),
            F.when(F.size(p) == 2, canonical(F.try_element_at(p, F.lit(2))))
            .otherwise(F.lit(UNDEFINED))
            .alias("pseudoFunc"),
        ),
    )
    return last_function_wins(mappings)


def last_function_wins(mappings: Column) -> Column:
    """One entry for each column: first place, last function. Entries without a function or a
    column name are dropped."""
    known = F.filter(mappings, lambda m: m["pseudoFunc"].isNotNull())
    return F.aggregate(
        known,
        F.array().cast(POLICY_TYPE),
        lambda seen, m: F.when(
            F.exists(seen, lambda s: s["var"].eqNullSafe(m["var"])),
            F.transform(seen, lambda s: F.when(s["var"].eqNullSafe(m["var"]), m).otherwise(s)),
        ).otherwise(F.concat(seen, F.array(m))),
    )


def to_policy_json(policy: Column) -> Column:
    return F.to_json(policy)


def from_policy_json(text: Column) -> Column:
    """The policy in a JSON text; null and malformed texts give the empty policy."""
    parsed = F.from_json(text, POLICY_TYPE, {"mode": "PERMISSIVE"})
    return F.coalesce(last_function_wins(parsed), F.array().cast(POLICY_TYPE))


def policy_vars(policy: Column) -> Column:
    return F.transform(policy, lambda m: m["var"])


def policy_functions(policy: Column) -> Column:
    return F.array_distinct(F.transform(policy, lambda m: m["pseudoFunc"]))


def function_of(policy: Column, var: Column) -> Column:
    """The function of a column, null when the policy does not list it."""
    return F.try_element_at(F.filter(policy, lambda m: m["var"] == var), F.lit(1))["pseudoFunc"]


# -- one text on the driver ---------------------------------------------------------------------


def parse_declaration(text: str) -> tuple[str, list[str]]:
    """``declaration`` for a single text."""
    plain = re.sub("[()]", " ", text).strip()
    name, blank, rest = plain.partition(" ")
    return name, [arg.strip() for arg in rest.split(",")] if blank else []


def parse_policy(option: str) -> list[tuple[str, str]]:
    """``parse_option`` for a single text: ``[(var, pseudoFunc)]``."""
    policy: dict[str, str] = {}
    for mapping in option.split(";"):
        parts = [part.strip() for part in mapping.split("=") if part.strip()]
        if len(parts) == 1:
            policy[parts[0]] = UNDEFINED
        elif len(parts) == 2:
            name, args = parse_declaration(parts[1])
            policy[parts[0]] = f"{name}({','.join(args)})"
    return list(policy.items())
