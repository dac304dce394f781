"""Business rules as data.

Adding a touchpoint, a credit flag, a do-not-contact age or a sampling stratum means
adding an entry here (or passing your own tuple to the operator).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

Values = tuple[str, ...]


@dataclass(frozen=True)
class TouchpointRule:
    """Facts whose local date lies between D-``oldest`` and D-``newest``.

    ``where`` and ``unless`` test dimension columns, ``fact`` tests fact columns;
    ``checkout_within`` asks for a check-out no older than that many days.
    """

    block: str
    newest: int
    oldest: int
    where: Mapping[str, Values] = field(default_factory=dict)
    unless: Mapping[str, Values] = field(default_factory=dict)
    fact: Mapping[str, tuple[int, ...]] = field(default_factory=dict)
    checkout_within: int | None = None


@dataclass(frozen=True)
class OriginRule:
    """One branch of the ordered credit-origin decision; set fields must all hold."""

    origin: str
    flow: str | None = None
    partner: int | None = None
    source: Values = ()
    campaign: str | None = None
    without_source: bool = False
    with_utm: bool = False


@dataclass(frozen=True)
class CreditRule:
    """A credit flag: loans in ``stage`` of the wanted origin or client type."""

    block: str
    stage: str
    from_points: bool | None = None
    client_type: str | None = None


@dataclass(frozen=True)
class Stratum:
    """People with the given credit flag and any / none of the listed flags."""

    survey: str
    credit: int
    rate: float
    any_of: Values = ()
    none_of: Values = ()


# ---------------------------------------------------------------------------
# Fixed values. Everything below must equal the published rules for results to
# agree: zone, levels, origins, states, lags, rates, dates and output texts.
# ---------------------------------------------------------------------------

BUSINESS_ZONE = "America/Sao_Paulo"
TAX_ID_WIDTH = 11

LEDGER_RULES = (
    TouchpointRule("bonus", 1, 1, {"nivel2": ("varejo",), "nivel3": ("bonus",)}, checkout_within=3),
    TouchpointRule("duplamarca", 3, 3, {"nivel2": ("duplamarca",)}, checkout_within=5),
    TouchpointRule("online", 1, 1, {"nivel2": ("online",)}),
    TouchpointRule(
        "varejo", 2, 2,
        {"nivel2": ("varejo",), "nivel3": ("supermercado", "outros")},
        fact={"CodigoSubTipoPromocao": (1,)},
    ),
    TouchpointRule("telecom", 2, 2, {"nivel2": ("varejo",), "nivel3": ("telecom",)}),
    TouchpointRule(
        "bancos", 7, 7, {"nivel2": ("bancos",)}, unless={"nivel3": ("especiais_1", "especiais2")}
    ),
    TouchpointRule("contapontos", 3, 3, {"nivel2": ("contapontos",)}),
)

# A digital exchange counts when it was just requested (any known status) or was
# requested one to two weeks ago and has been delivered, hence its two entries.
VALID_EXCHANGE = "S"
EXCHANGE_DELIVERED = "OK - Produto Entregue"
EXCHANGE_RULES = (
    TouchpointRule("trip", 3, 3, {"DescricaoOrigemexchange": ("trippontos",)}),
    TouchpointRule("physicalchannel", 2, 2, {"DescricaoOrigemexchange": ("physicalchannel", "tef")}),
    TouchpointRule(
        "digitalchannel", 1, 1,
        {"DescricaoOrigemexchange": ("mobile", "site"), "status_known": ("true",)},
    ),
    TouchpointRule(
        "digitalchannel", 7, 15,
        {
            "DescricaoOrigemexchange": ("mobile", "site"),
            "NomeStatusexchange": (EXCHANGE_DELIVERED,),
        },
    ),
    TouchpointRule("money", 3, 3, {"DescricaoOrigemexchange": ("contapontos",)}),
)

PAYMENT_LAG = 3
PAYMENT_CONFIRMED = "CONFIRMED"
NATURAL_PERSON = "F"
PAYMENT_PARTIES = (("pix_sent", "debitParty"), ("pix_received", "creditParty"))

CARD_LAG = 3
CARD_PURCHASE = "Compra"

CREDIT_LAG = 3
LOAN_LENT = "lent"
LOAN_SETTLED = "settled"
CONTRACT_STATUS = "contrato ativo"
SETTLED_ON_TIME = "em_dia"
SETTLED_LATE = "atraso"

CLIENT_TYPES = {
    "fgts_flow": "FGTS",
    "default_flow": "Cliente Novo",
    "pre_approved_flow": "Pre aprovado",
    "recurring_flow": "Recorrente",
}
OTHER_CLIENT_TYPE = "exchangeeGanhe"

POINTS_ORIGIN = "pontos"
ORIGIN_RULES = (
    OriginRule("positivo", flow="refinancing_flow"),
    OriginRule("credpartner3", partner=3),
    OriginRule("credpartner4", partner=4),
    OriginRule("credpartner5", partner=5),
    OriginRule("pontos", flow="pre_approved_flow", without_source=True),
    OriginRule("credpartner1", partner=1, campaign="finanzero"),
    OriginRule("credpartner2", partner=1, source=("pontos", "responsys")),
    OriginRule("Outros", partner=1, with_utm=True),
)
OTHER_ORIGIN = "positivo"

CREDIT_RULES = (
    CreditRule("aquisicaoplus", LOAN_LENT, from_points=False),
    CreditRule("aquisicaopts", LOAN_LENT, from_points=True),
    CreditRule("aquisicaofgts", LOAN_LENT, client_type="FGTS"),
    CreditRule("quitadosplus", LOAN_SETTLED, from_points=False),
    CreditRule("quitadospts", LOAN_SETTLED, from_points=True),
)

ADDITIONS = ("bonus", "duplamarca", "online", "varejo", "telecom", "bancos")
EXCHANGES = ("trip", "physicalchannel", "digitalchannel", "money")
ACCOUNT = ("contapontos", "pix_sent", "pix_received", "bondcard")
CREDIT = ("aquisicaoplus", "aquisicaopts", "aquisicaofgts", "quitadosplus", "quitadospts")

# Flag columns in output order, each with the selection blocks that set it.
FLAGS = {
    "addition": ADDITIONS,
    "exchange": EXCHANGES,
    "contapontos": ACCOUNT,
    "credito": CREDIT,
    "bonus": ("bonus",),
    "duplamarca": ("duplamarca",),
    "online": ("online",),
    "varejo": ("varejo",),
    "telecom": ("telecom",),
    "bancos": ("bancos",),
    "trip": ("trip",),
    "physicalchannel": ("physicalchannel",),
    "digitalchannel": ("digitalchannel",),
    "money": ("money",),
    "acumctadigital": ("contapontos",),
    "pix": ("pix_sent", "pix_received"),
    "cartaobond": ("bondcard",),
    "aquisicaoplus": ("aquisicaoplus",),
    "aquisicaopts": ("aquisicaopts",),
    "aquisicaofgts": ("aquisicaofgts",),
    "quitadosplus": ("quitadosplus",),
    "quitadospts": ("quitadospts",),
}

BAD_EMAIL_SCORES = ("Ruim", "Médio")
ACTIVE_ACCOUNT = "Ativado"
ACCOUNT_LOSS = "Conta Digital"
INDICATOR_CUSTOMER = "chavecliente"
INDICATOR_TAX_ID = "numerocpf"
QUARANTINE_DAYS = {False: 15, True: 90}

STRATA = (
    Stratum("positivo", credit=1, rate=0.05, none_of=("aquisicaopts", "quitadospts")),
    Stratum("pontos", credit=0, rate=0.50, any_of=("bonus", "trip")),
    Stratum("pontos", credit=0, rate=0.05, none_of=("bonus", "trip")),
    Stratum("pontos", credit=1, rate=0.05, any_of=("aquisicaopts", "quitadospts")),
)
DEFAULT_GREETING = {"positivo": "CLIENTE positivo", "pontos": "CLIENTE pontos"}

PROMOTER, NEUTRAL, DETRACTOR = "PROMOTOR", "NEUTRO", "DETRATOR"
ANSWERS_SINCE = date(2023, 11, 1)
SAMPLE_RATE_CHANGE = date(2024, 2, 9)
SAMPLE_RATE_BEFORE, SAMPLE_RATE_AFTER = 5.0, 7.5
WEEK_DAYS = 7

FORECAST_WEEKS = 4
SCORE_ORDER = (3, 1)
RESPONDENTS_ORDER = (0, 1)
INTERVAL_ALPHA = 0.5
MAX_ITERATIONS = 300
DASHBOARD_HIDDEN_WEEKS = 2
