"""Selection blocks as bits of one integer.

A customer's touchpoints travel as a single ``blocks`` integer and meet in ``bit_or``,
which Spark combines map-side: a customer with a third of all rows still sends one row
per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from loyalpulse.rules import (
    ACCOUNT,
    ADDITIONS,
    CREDIT,
    CREDIT_RULES,
    EXCHANGE_RULES,
    EXCHANGES,
    FLAGS,
    LEDGER_RULES,
    PAYMENT_PARTIES,
    CreditRule,
    TouchpointRule,
)

BLOCKS = ADDITIONS + EXCHANGES + ACCOUNT + CREDIT
MOST_BLOCKS = 62


def any_of(tests: Iterable[str]) -> str:
    return " OR ".join(f"({test})" for test in tests)


def sum_bits(bits: Iterable[tuple[int, str]]) -> str:
    """OR of the bits whose SQL test is true; an unknown test does not count."""
    return " | ".join(f"if({test}, {bit}, 0)" for bit, test in bits) or "0"


@dataclass(frozen=True)
class RuleSet:
    """The rules of a run, and the bits and flag columns they compile to.

    The usual blocks keep their bits, and blocks of further rules take the next ones, so an
    operator that knows only the usual blocks reads any rule set's ``blocks`` rightly.
    ``flags`` are the flag columns in output order, each with the blocks that set it.
    """

    ledger: tuple[TouchpointRule, ...] = LEDGER_RULES
    exchange: tuple[TouchpointRule, ...] = EXCHANGE_RULES
    parties: tuple[tuple[str, str], ...] = PAYMENT_PARTIES
    card: bool = True
    credit: tuple[CreditRule, ...] = CREDIT_RULES
    flags: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: dict(FLAGS))

    def __post_init__(self) -> None:
        shown = {block for blocks in self.flags.values() for block in blocks}
        if shown - set(self.blocks):
            raise ValueError(f"flags of blocks that no rule sets: {sorted(shown - set(self.blocks))}")
        if set(self.blocks) - set(BLOCKS) - shown:
            raise ValueError(f"blocks that set no flag: {sorted(set(self.blocks) - set(BLOCKS) - shown)}")
        if len(self.blocks) > MOST_BLOCKS:
            raise ValueError(f"{len(self.blocks)} blocks, {MOST_BLOCKS} at most")

    def with_rules(
        self,
        flag: str,
        ledger: Iterable[TouchpointRule] = (),
        exchange: Iterable[TouchpointRule] = (),
        credit: Iterable[CreditRule] = (),
    ) -> RuleSet:
        """These rules and more, whose hits set the column ``flag`` besides their own usual ones."""
        ledger, exchange, credit = tuple(ledger), tuple(exchange), tuple(credit)
        blocks = (*self.flags.get(flag, ()), *(rule.block for rule in (*ledger, *exchange, *credit)))
        return replace(
            self,
            ledger=self.ledger + ledger,
            exchange=self.exchange + exchange,
            credit=self.credit + credit,
            flags={**self.flags, flag: tuple(dict.fromkeys(blocks))},
        )

    @cached_property
    def blocks(self) -> tuple[str, ...]:
        named = [rule.block for rule in (*self.ledger, *self.exchange, *self.credit)]
        return tuple(dict.fromkeys((*BLOCKS, *named, *(block for block, _ in self.parties))))

    @cached_property
    def credit_blocks(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys((*CREDIT, *(rule.block for rule in self.credit))))

    @cached_property
    def bit(self) -> dict[str, int]:
        return {block: 1 << position for position, block in enumerate(self.blocks)}

    @property
    def all_blocks(self) -> int:
        return (1 << len(self.blocks)) - 1

    def mask(self, blocks: Iterable[str]) -> int:
        return reduce(or_, (self.bit[block] for block in blocks), 0)

    def has_any(self, blocks: Iterable[str]) -> str:
        """SQL test for any of the blocks."""
        return f"(blocks & {self.mask(blocks)}) <> 0"

    def flag_columns(self, flags: Iterable[str] | None = None) -> list[str]:
        """SQL of the 0/1 flag columns of a ``blocks`` integer."""
        chosen = self.flags if flags is None else flags
        return [f"if({self.has_any(self.flags[flag])}, 1, 0) AS {flag}" for flag in chosen]

    def flag_bits(self) -> str:
        """The flags as one integer, first flag most significant."""
        top = len(self.flags) - 1
        return sum_bits(
            (1 << (top - i), self.has_any(blocks)) for i, blocks in enumerate(self.flags.values())
        )


RULES = RuleSet()
BIT = RULES.bit
mask = RULES.mask
has_any = RULES.has_any


def merge_blocks() -> Column:
    return F.bit_or("blocks").alias("blocks")
