"""Reproducible stratified draw.

A person is drawn when the hash of tax id, run date and salt falls below the rate of
their stratum.  The draw needs no shuffle, is the same after a lost executor or a
repartition, and nests: raising a rate only adds people.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loyalpulse.context import RunContext
from loyalpulse.rules import STRATA, Stratum

HEX_DIGITS = 12
_DRAWN_SALT, _DRAWN_BELOW = "drawn_salt", "drawn_below"


def threshold(rate: float) -> str:
    """Hex text below which a share ``rate`` of hash texts sorts."""
    if rate >= 1:
        return "g"
    return format(round(max(rate, 0.0) * 16**HEX_DIGITS), f"0{HEX_DIGITS}x")


def _salt(ctx: RunContext) -> str:
    return f"|{ctx.as_of.isoformat()}|{ctx.draw_salt}"


def _hash(cpf: str, salt: str) -> Column:
    return F.md5(F.concat(F.col(cpf), F.lit(salt)))


def draw_hash(cpf: str, ctx: RunContext) -> Column:
    return _hash(cpf, _salt(ctx))


def may_be_drawn(cpf: str, survey: str, ctx: RunContext, strata: Sequence[Stratum] = STRATA) -> Column:
    """True for every tax id any stratum of the survey could draw."""
    top = max(threshold(stratum.rate) for stratum in strata if stratum.survey == survey)
    return draw_hash(cpf, ctx) < top


def could_be_in(cpf: str, drawn: DataFrame) -> Column:
    """True for every tax id that the draw of ``drawn`` could take.

    It depends on the id alone, so contact tables can be cut with it before their join.
    The draw notes salt and highest rate in the metadata of its ``cpf``, which stored tables
    keep; where they are missing, every id may have been drawn.
    """
    noted = drawn.schema["cpf"].metadata
    if not {_DRAWN_SALT, _DRAWN_BELOW} <= set(noted):
        return F.lit(True)
    return _hash(cpf, noted[_DRAWN_SALT]) < noted[_DRAWN_BELOW]


def in_stratum(stratum: Stratum) -> str:
    """SQL test of the stratum's flags."""
    tests = [f"credito = {stratum.credit}"]
    if stratum.any_of:
        tests.append(f"1 IN ({', '.join(stratum.any_of)})")
    if stratum.none_of:
        tests.append(f"1 NOT IN ({', '.join(stratum.none_of)})")
    return " AND ".join(tests)


def draw(
    people: DataFrame, survey: str, ctx: RunContext, strata: Sequence[Stratum] = STRATA
) -> DataFrame:
    """The people drawn for one survey, all its strata in one pass."""
    own = [stratum for stratum in strata if stratum.survey == survey]
    if not own:
        raise ValueError(f"no stratum of survey {survey!r}")
    limit = F
    for stratum in own:
        limit = limit.when(F.expr(in_stratum(stratum)), threshold(stratum.rate))
    noted = {_DRAWN_SALT: _salt(ctx), _DRAWN_BELOW: max(threshold(stratum.rate) for stratum in own)}
    return people.filter(draw_hash("cpf", ctx) < limit).withMetadata("cpf", noted)
