"""The benchmark tables seen as the domain tables.

One text per table, written in the SQL that Spark and DuckDB share; the few expressions
they spell differently come from a ``Dialect``.  Timestamps stay UTC.
"""

from __future__ import annotations

from datetime import date
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

REFERENCE_DAY = date(2024, 1, 20)
BASE_TABLES = {
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


LEVEL_2 = ("varejo", "duplamarca", "online", "varejo", "bancos", "contapontos")
# a size without an entry has no second level
LEVEL_3 = ("bonus", "supermercado", "outros", "telecom", "especiais_1", "banco_x")


class SparkDialect:
    def table(self, name: str) -> str:
        return "{" + name + "}"

    def folded(self, day: str, hours: str, days_back: str = "0") -> str:
        """A long range of dates wrapped into January 2024, as an instant."""
        since = f"datediff(CAST({day} AS DATE), DATE '1995-01-01') % 30"
        start = "datediff(DATE '2024-01-01', DATE '1970-01-01')"
        return f"timestamp_seconds(({start} + {since} - {days_back}) * 86400 + {hours} * 3600)"

    def plus(self, instant: str, days: str = "0", hours: str = "0") -> str:
        return f"timestampadd(HOUR, CAST(({days}) * 24 + {hours} AS INT), {instant})"

    def date_plus(self, day: str, days: str) -> str:
        return f"date_add({day}, CAST({days} AS INT))"

    def pairs(self, *pairs: tuple[str, str]) -> str:
        structs = (f"named_struct('column', '{n}', 'value', {v})" for n, v in pairs)
        return f"array({', '.join(structs)})"

    def pick(self, place: str, values: tuple[str, ...]) -> str:
        """The value at a place counted from zero, NULL beyond the last."""
        listed = ", ".join(f"'{v}'" for v in values)
        return f"try_element_at(array({listed}), CAST({place} AS INT) + 1)"

    def json(self, text: str) -> str:
        return "'" + text.replace("{", "{{").replace("}", "}}") + "'"

    def midnight(self, day: str) -> str:
        return f"TIMESTAMP_NTZ '{day} 00:00:00'"

    def no_pairs(self) -> str:
        return "CAST(array() AS ARRAY<STRUCT<column: STRING, value: STRING>>)"


class DuckDialect:
    def table(self, name: str) -> str:
        return name

    def folded(self, day: str, hours: str, days_back: str = "0") -> str:
        since = f"(CAST({day} AS DATE) - DATE '1995-01-01') % 30"
        day_of = f"DATE '2024-01-01' + CAST({since} - {days_back} AS INTEGER)"
        return f"CAST({day_of} AS TIMESTAMP) + to_hours(CAST({hours} AS INTEGER))"

    def plus(self, instant: str, days: str = "0", hours: str = "0") -> str:
        return f"{instant} + to_days(CAST({days} AS INTEGER)) + to_hours(CAST({hours} AS INTEGER))"

    def date_plus(self, day: str, days: str) -> str:
        return f"{day} + CAST({days} AS INTEGER)"

    def pairs(self, *pairs: tuple[str, str]) -> str:
        structs = (f"{{'column': '{n}', 'value': {v}}}" for n, v in pairs)
        return f"[{', '.join(structs)}]"

    def pick(self, place: str, values: tuple[str, ...]) -> str:
        listed = ", ".join(f"'{v}'" for v in values)
        return f"list_extract([{listed}], CAST({place} AS INTEGER) + 1)"

    def json(self, text: str) -> str:
        return f"'{text}'"

    def midnight(self, day: str) -> str:
        return f"TIMESTAMP '{day} 00:00:00'"

    def no_pairs(self) -> str:
        return "CAST([] AS STRUCT(\"column\" VARCHAR, \"value\" VARCHAR)[])"


def domain_sql(q) -> dict[str, str]:
    """Domain table name to its SELECT over the benchmark tables."""
    t = q.table
    loan_clock = q.folded("o_orderdate", "(o_orderkey % 24)")
    processed = q.folded("l_shipdate", "(l_orderkey % 24)")
    checkout = q.folded("l_shipdate", "(l_orderkey % 24)", "l_linenumber % 7")
    # every twentieth customer is a second registration of the one before, some have no id
    owner = "(c_custkey - CASE WHEN c_custkey % 20 = 1 THEN 1 ELSE 0 END)"
    padded_owner = f"lpad(CAST({owner} AS STRING), 11, '0')"
    padded_customer = "lpad(CAST(c_custkey AS STRING), 11, '0')"
    padded_buyer = "lpad(CAST(o_custkey AS STRING), 11, '0')"
    indicators = q.pairs(
        ("chavecliente", "CAST(o_custkey AS STRING)"), ("numerocpf", padded_buyer)
    )
    # the last orders (August 2001) become surveys sent in the weeks before the run
    sent = q.plus("o_orderdate", days="8200", hours="o_orderkey % 24")
    utm = [
        q.json('{"utm_source": "pontos"}'),
        q.json('{"utm_source": ["a"], "utm_campaign": "finanzero"}'),
        q.json('{"utm_source": "web", "utm_campaign": "x"}'),
    ]
    return {
        "answers": f"""
            SELECT CAST(o_orderdate AS DATE) AS dataref,
                   CASE WHEN o_orderpriority < '3' THEN 'PROMOTOR'
                        WHEN o_orderpriority < '4' THEN 'NEUTRO'
                        ELSE 'DETRATOR' END AS Classificacao,
                   o_orderstatus AS segment
            FROM {t("orders")}""",
        "extrato": f"""
            SELECT o_custkey AS chavecliente,
                   l_partkey AS chaveparceiro,
                   l_suppkey AS chavefilialparceiro,
                   {processed} AS DataProcessamentoTransacao,
                   {checkout} AS DataCheckOut,
                   CAST(l_linenumber % 3 AS INT) AS CodigoSubTipoPromocao
            FROM {t("lineitem")} JOIN {t("orders")} ON l_orderkey = o_orderkey""",
        "parceiros": f"""
            SELECT l_partkey AS chaveparceiro,
                   l_suppkey AS chavefilialparceiro,
                   {q.pick("l_partkey % 6", LEVEL_2)} AS nivel2,
                   {q.pick("p_size % 7", LEVEL_3)} AS nivel3
            FROM (SELECT DISTINCT l_partkey, l_suppkey FROM {t("lineitem")}) AS pairs
            JOIN {t("part")} ON l_partkey = p_partkey""",
        "exchange": f"""
            SELECT user_id AS chavecliente,
                   event_id % 6 AS chavetable_exchange,
                   event_id % 3 AS ChaveStatusexchange,
                   ts AS DataSolicitacaoexchange,
                   CASE WHEN event_id % 10 = 0 THEN 'N' ELSE 'S' END AS FlagexchangeValida
            FROM {t("events")}""",
        "classe_exchange": """
            SELECT CAST(k AS BIGINT) AS chavetable_exchange, v AS DescricaoOrigemexchange
            FROM (VALUES (0, 'trippontos'), (1, 'physicalchannel'), (2, 'tef'), (3, 'mobile'),
                         (4, 'site'), (5, 'contapontos')) AS classes(k, v)""",
        "status_exchange": """
            SELECT CAST(k AS BIGINT) AS ChaveStatusexchange, v AS NomeStatusexchange
            FROM (VALUES (0, 'OK - Produto Entregue'), (1, 'Pendente'), (2, 'Cancelado'))
                 AS statuses(k, v)""",
        "transactions": f"""
            SELECT CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'CONFIRMED' END AS status,
                   CAST(user_id AS STRING) AS debitPartyTaxId,
                   CASE WHEN event_id % 5 = 0 THEN 'J' ELSE 'F' END AS debitPartyPersonType,
                   lpad(CAST((user_id * 7 + 3) % 150 AS STRING), 11, '0') AS creditPartyTaxId,
                   CASE WHEN event_id % 5 = 0 THEN 'J' ELSE 'F' END AS creditPartyPersonType,
                   ts AS createTimestamp
            FROM {t("events")}""",
        "customers_a": f"""
            SELECT c_custkey AS chavecliente,
                   CASE WHEN c_custkey % 89 <> 5 THEN CAST({owner} AS STRING) END
                        AS NumeroDocumento,
                   CASE WHEN c_custkey % 97 = 0 THEN NULL
                        WHEN c_acctbal < 0 THEN 'Cancelado' ELSE 'Ativado' END
                        AS DescricaoStatusConta,
                   CASE WHEN c_custkey % 31 = 0 THEN '  '
                        ELSE replace(c_name, '#', ' ') END AS DescricaoNome,
                   '55119' || lpad(CAST(c_custkey AS STRING), 8, '0') AS NumeroTelefone,
                   {q.plus(q.midnight("2023-01-01"), days="c_custkey % 365")}
                        AS DataUltimaAlteracaoCadastro
            FROM {t("customer")}""",
        "digital_account": f"""
            SELECT CAST(l_linenumber AS BIGINT) AS ID_DOC,
                   l_suppkey AS ID_CONTA,
                   {processed} AS DT_TRANSACAO_TIMESTAMP
            FROM {t("lineitem")}""",
        "digital_account_docs": f"""
            SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS id_doc,
                   CASE WHEN l_linenumber % 2 = 1 THEN 'Compra' ELSE 'Saque' END
                        AS natureza_transacao
            FROM {t("lineitem")}""",
        "digital_account_type": f"""
            SELECT s_suppkey AS ID_CONTA, s_suppkey + 1000 AS ID_PESSOAFISICA
            FROM {t("supplier")}""",
        "digital_account_person": f"""
            SELECT s_suppkey + 1000 AS ID_PESSOAFISICA, s_suppkey AS NU_CPF
            FROM {t("supplier")}""",
        "borrowers": f"""
            SELECT c_custkey AS id,
                   CASE WHEN c_custkey % 2 = 0 THEN {padded_customer}
                        ELSE CAST(c_custkey AS STRING) END AS document,
                   CASE WHEN c_custkey % 31 = 0 THEN ''
                        ELSE replace(c_name, '#', ' ') END AS name,
                   'user' || CAST(c_custkey AS STRING) || '@example.com' AS email,
                   CASE WHEN c_custkey % 43 = 0 THEN 'unknown'
                        ELSE '55119' || lpad(CAST(c_custkey AS STRING), 8, '0') END
                        AS mobile_number,
                   'city' || CAST(c_nationkey AS STRING) AS address_city,
                   c_mktsegment AS address_state,
                   {q.date_plus("DATE '1960-01-01'", "(c_custkey * 37) % 14000")} AS birthdate,
                   c_custkey % 50 = 0 AS lgpd_excluded_data
            FROM {t("customer")}""",
        "loans": f"""
            SELECT o_orderkey AS id,
                   o_custkey AS borrower_id,
                   CAST(o_orderkey % 5 + 1 AS INT) AS partner_id,
                   CASE o_orderkey % 6 WHEN 0 THEN 'fgts_flow' WHEN 1 THEN 'default_flow'
                        WHEN 2 THEN 'pre_approved_flow' WHEN 3 THEN 'recurring_flow'
                        WHEN 4 THEN 'refinancing_flow' ELSE 'other_flow' END AS flow,
                   CASE o_orderstatus WHEN 'F' THEN 'settled' WHEN 'O' THEN 'lent'
                        ELSE 'open' END AS state,
                   CASE o_orderkey % 4 WHEN 1 THEN {utm[0]} WHEN 2 THEN {utm[1]}
                        WHEN 3 THEN {utm[2]} END AS utm_data,
                   {loan_clock} AS lent_at,
                   {loan_clock} AS settled_at
            FROM {t("orders")}""",
        "parcelas": f"""
            SELECT l_orderkey AS loan_id,
                   CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS late_at
            FROM {t("lineitem")}""",
        "contatos": f"""
            SELECT c_custkey AS chavecliente,
                   {padded_owner} AS CPF,
                   CASE c_custkey % 8 WHEN 0 THEN 'Ruim' WHEN 1 THEN 'Médio' WHEN 2 THEN NULL
                        ELSE 'Bom' END AS FaixaScoreEmail,
                   'user' || CAST(c_custkey AS STRING) || '@example.com' AS EMAIL
            FROM {t("customer")}""",
        "optout": f"""
            SELECT c_custkey AS chavecliente, c_custkey AS CPF
            FROM {t("customer")} WHERE c_nationkey = 7""",
        "funcionarios": f"""
            SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS CPF
            FROM {t("customer")} WHERE c_nationkey = 11""",
        "losses": f"""
            SELECT 'Conta Digital' AS Tipo_Perda, CAST(s_suppkey AS STRING) AS Cod_Cliente
            FROM {t("supplier")} WHERE s_acctbal < 1000
            UNION ALL
            SELECT CASE WHEN c_nationkey <> 3 THEN 'Cartao' END AS Tipo_Perda,
                   {padded_customer} AS Cod_Cliente
            FROM {t("customer")} WHERE c_acctbal > 9800""",
        "coplusites": f"""
            SELECT CAST(o_orderkey AS STRING) AS _id,
                   {sent} AS createdAt,
                   CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS answered,
                   CASE WHEN o_orderkey % 10 = 0 THEN {q.no_pairs()} ELSE {indicators} END
                        AS indicators
            FROM {t("orders")}""",
    }


DUCK_VIEWS = MappingProxyType(domain_sql(DuckDialect()))
SPARK_VIEWS = MappingProxyType(domain_sql(SparkDialect()))


class Domain(dict):
    """Domain tables over one benchmark folder.

    A table is built when first asked for, so a query plans only what it reads; declared
    schemas spare the footer reads of schema inference.
    """

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self._spark, self._folder = spark, sf_dir.rstrip("/")
        self._base: dict[str, DataFrame] = {}

    def _read(self, table: str) -> DataFrame:
        if table not in self._base:
            reader = self._spark.read.schema(BASE_TABLES[table])
            self._base[table] = reader.parquet(f"{self._folder}/{table}.parquet")
        return self._base[table]

    def __missing__(self, name: str) -> DataFrame:
        text = SPARK_VIEWS[name]
        used = {table: self._read(table) for table in BASE_TABLES if "{" + table + "}" in text}
        self[name] = self._spark.sql(text, **used) if used else self._spark.sql(text)
        return self[name]
