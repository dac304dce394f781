"""The eligibility run: touched people, minus the lists, drawn, with contact data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation

from loyalpulse.context import RunContext
from loyalpulse.functions.blocks import RULES, RuleSet
from loyalpulse.operators.consolidate import eligible
from loyalpulse.operators.contact import contact_credit, contact_points
from loyalpulse.operators.sampling import draw
from loyalpulse.operators.suppression import (
    blocked_ids,
    listed_ids,
    observed_reasons,
    suppress,
    suppress_counted,
)
from loyalpulse.operators.touchpoints import Sources
from loyalpulse.plans.stages import StageLog
from loyalpulse.rules import STRATA, Stratum
from loyalpulse.sources.tables import Workspace


def unrestricted(sources: Sources, ctx: RunContext, rules: RuleSet = RULES) -> DataFrame:
    """Eligible people on no do-not-contact list."""
    return suppress(eligible(sources, ctx, rules), blocked_ids(sources, ctx))


def contacted(
    people: DataFrame,
    sources: Sources,
    ctx: RunContext,
    strata: Sequence[Stratum] = STRATA,
    rules: RuleSet = RULES,
) -> dict[str, DataFrame]:
    """Survey name to the people drawn for it, with contact data."""
    credit = draw(people, "positivo", ctx, strata)
    points = draw(people, "pontos", ctx, strata)
    flags = tuple(rules.flags)
    return {
        "positivo": contact_credit(credit, sources["borrowers"], ctx, flags),
        "pontos": contact_points(points, sources["customers_a"], sources["contatos"], ctx, flags),
    }


def surveys(
    sources: Sources,
    ctx: RunContext,
    strata: Sequence[Stratum] = STRATA,
    rules: RuleSet = RULES,
) -> dict[str, DataFrame]:
    """The whole run as lazy frames."""
    return contacted(unrestricted(sources, ctx, rules), sources, ctx, strata, rules)


def run_eligibility(
    sources: Sources,
    ctx: RunContext,
    workspace: Workspace,
    strata: Sequence[Stratum] = STRATA,
    rules: RuleSet = RULES,
) -> StageLog:
    """The run with each of its four results written and read back.

    ``rules`` may hold touchpoints and flags of your own (``RuleSet.with_rules``).

    ``suppressed_by_list`` says how many people each do-not-contact list removed, and how
    many of them no other list would have; it is counted while the allowed people are written.
    """
    log = StageLog()
    with log.timed("eligible_people"):
        people = workspace.materialize(eligible(sources, ctx, rules), "eligible_people")
    with log.timed("unrestricted_people"):
        observation = Observation("suppressed_by_list")
        allowed = suppress_counted(people, listed_ids(sources, ctx), observation=observation)
        allowed = workspace.materialize(allowed, "unrestricted_people")
        reasons = people.sparkSession.createDataFrame(
            observed_reasons(observation), "list string, blocked bigint, blocked_alone bigint"
        )
        workspace.materialize(reasons, "suppressed_by_list")
    for survey, rows in contacted(allowed, sources, ctx, strata, rules).items():
        with log.timed(f"survey_{survey}"):
            workspace.materialize(rows, f"survey_{survey}")
    return log
