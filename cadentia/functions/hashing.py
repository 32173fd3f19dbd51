"""Reproducible uniforms from integer arithmetic.

``rand()`` depends on partitioning; these depend only on ``(id, draw, seed)``, so
a re-run task, another partition count or another SQL engine gives equal numbers.
Quadratic mixing modulo a Mersenne prime: all products stay below 2**63 while
``id < 1.9e14``.

Arguments are SQL expressions (a column name, a lambda variable, a literal). Text
keeps the many small terms of a draw to a single parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2147483647


def hashed_int_sql(id_: str, draw: str | int, seed: str | int, *, bind: bool = False) -> str:
    """Integer in ``[0, PRIME)``.

    As a column this is plain arithmetic, which compiles; inside a lambda, where
    everything is interpreted, ``bind`` keeps a step that is used twice from being
    computed twice.
    """
    x1 = f"((({id_}) * 48271L + ({draw}) * 69621L + ({seed}) * 16807L + 12345L) % {PRIME}L)"
    x2 = lambda a: f"(({a} * {a} + ({draw}) * 7919L + 1L) % {PRIME}L)"
    x3 = lambda a, b: f"(({b} * 48271L + {a}) % {PRIME}L)"
    x4 = lambda c: f"(({c} * {c} + {c} + ({draw})) % {PRIME}L)"
    if bind:
        return let_sql("a", x1, let_sql("b", x2("a"), let_sql("c", x3("a", "b"), x4("c"))))
    return x4(x3(x1, x2(x1)))


def uniform_sql(id_: str, draw: str | int, seed: str | int, *, bind: bool = False) -> str:
    """Double in ``[0, 1)``."""
    return f"({hashed_int_sql(id_, draw, seed, bind=bind)} / {PRIME}D)"


def let_sql(name: str, value: str, body: str) -> str:
    """``value`` evaluated once and bound to ``name`` in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def uniform(id_: str, draw: str | int, seed: str | int) -> Column:
    return F.expr(uniform_sql(id_, draw, seed))


def hashed_int(id_: str, draw: str | int, seed: str | int) -> Column:
    return F.expr(hashed_int_sql(id_, draw, seed))
