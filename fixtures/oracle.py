"""Check SQL for DuckDB, one statement per registered query.

The statements are written from the rules, not from the operators: blocks are tested one
at a time, lists are removed with NOT EXISTS, and the split rows come from an actual
chain of full outer joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from fixtures.views import DUCK_VIEWS, REFERENCE_DAY

REF = f"DATE '{REFERENCE_DAY}'"
FLAGS = (
    "addition exchange contapontos credito bonus duplamarca online varejo telecom bancos trip "
    "physicalchannel digitalchannel money acumctadigital pix cartaobond aquisicaoplus "
    "aquisicaopts aquisicaofgts quitadosplus quitadospts"
).split()
CREDIT_FLAGS = ["credito", *FLAGS[17:]]
POINTS_FLAGS = [flag for flag in FLAGS if flag not in CREDIT_FLAGS]

ANSWERS_SINCE, RATE_CHANGE = "DATE '1995-01-01'", "DATE '1998-01-01'"
SERIES_DAY, OBSERVED_DAY, EARLIER_DAY = "2001-08-02", "2001-07-31", "2001-07-26"


def local(ts: str) -> str:
    """Sao Paulo date of a UTC timestamp."""
    return f"CAST(timezone('America/Sao_Paulo', timezone('UTC', {ts})) AS DATE)"


def back(days: int) -> str:
    return f"({REF} - {days})"


def padded(value: str) -> str:
    return f"lpad(CAST({value} AS VARCHAR), 11, '0')"


def tax_id(value: str) -> str:
    """Marks an id that is padded, or left as stored for the literal statements."""
    return f"<<{value}>>"


def columns(names: Iterable[str], prefix: str = "") -> str:
    return ", ".join(prefix + name for name in names)


# --- touchpoints -----------------------------------------------------------------------


def ledger(flags: tuple[str, ...], test: str) -> str:
    constants = ", ".join(f"1 AS {flag}" for flag in flags)
    return f"""SELECT DISTINCT chavecliente, {constants}
        FROM (SELECT *, {local("DataProcessamentoTransacao")} AS processed,
                     {local("DataCheckOut")} AS checkout FROM extrato) AS facts
        JOIN parceiros USING (chaveparceiro, chavefilialparceiro) WHERE {test}"""


def exchanged(flag: str, test: str) -> str:
    return f"""SELECT DISTINCT chavecliente, 1 AS exchange, 1 AS {flag}
        FROM (SELECT *, {local("DataSolicitacaoexchange")} AS requested FROM exchange) AS facts
        JOIN classe_exchange USING (chavetable_exchange)
        JOIN status_exchange USING (ChaveStatusexchange)
        WHERE FlagexchangeValida = 'S' AND {test}"""


def paid(party: str) -> str:
    return f"""SELECT DISTINCT c.chavecliente, 1 AS pix, 1 AS contapontos
        FROM customers_a AS c
        WHERE EXISTS (SELECT 1 FROM transactions AS t
            WHERE {padded(f"t.{party}TaxId")} = {padded("c.NumeroDocumento")}
              AND t.status = 'CONFIRMED' AND t.{party}PersonType = 'F'
              AND {local("t.createTimestamp")} = {back(3)})"""


TOUCHPOINTS = {
    "tp_bonus": ledger(
        ("addition", "bonus"),
        f"processed = {back(1)} AND checkout >= {back(3)} AND nivel2 = 'varejo' AND nivel3 = 'bonus'",
    ),
    "tp_duplamarca": ledger(
        ("addition", "duplamarca"),
        f"processed = {back(3)} AND checkout >= {back(5)} AND nivel2 = 'duplamarca'",
    ),
    "tp_online": ledger(("addition", "online"), f"processed = {back(1)} AND nivel2 = 'online'"),
    "tp_varejo": ledger(
        ("addition", "varejo"),
        f"processed = {back(2)} AND CodigoSubTipoPromocao = 1 AND nivel2 = 'varejo' "
        "AND (nivel3 = 'supermercado' OR nivel3 = 'outros')",
    ),
    "tp_telecom": ledger(
        ("addition", "telecom"),
        f"processed = {back(2)} AND nivel2 = 'varejo' AND nivel3 = 'telecom'",
    ),
    "tp_bancos": ledger(
        ("addition", "bancos"),
        f"processed = {back(7)} AND nivel2 = 'bancos' "
        "AND nivel3 <> 'especiais_1' AND nivel3 <> 'especiais2'",
    ),
    "tp_contapontos": ledger(
        ("contapontos", "acumctadigital"), f"processed = {back(3)} AND nivel2 = 'contapontos'"
    ),
    "tp_trip": exchanged(
        "trip", f"requested = {back(3)} AND DescricaoOrigemexchange = 'trippontos'"
    ),
    "tp_physicalchannel": exchanged(
        "physicalchannel",
        f"requested = {back(2)} AND DescricaoOrigemexchange IN ('physicalchannel', 'tef')",
    ),
    "tp_digitalchannel": exchanged(
        "digitalchannel",
        "DescricaoOrigemexchange IN ('mobile', 'site') AND CASE "
        f"WHEN requested = {back(1)} THEN TRUE "
        f"WHEN requested >= {back(15)} AND requested <= {back(7)} "
        "THEN NomeStatusexchange = 'OK - Produto Entregue' ELSE FALSE END",
    ),
    "tp_money": exchanged(
        "money", f"requested = {back(3)} AND DescricaoOrigemexchange = 'contapontos'"
    ),
    "tp_pix_sent": paid("debitParty"),
    "tp_pix_received": paid("creditParty"),
    "tp_bondcard": f"""SELECT DISTINCT chavecliente, 1 AS cartaobond, 1 AS contapontos
        FROM customers_a WHERE {padded("NumeroDocumento")} IN (
            SELECT {padded("NU_CPF")} FROM digital_account_person WHERE ID_PESSOAFISICA IN (
                SELECT ID_PESSOAFISICA FROM digital_account_type WHERE ID_CONTA IN (
                    SELECT ID_CONTA FROM digital_account
                    WHERE {local("DT_TRANSACAO_TIMESTAMP")} = {back(3)} AND ID_DOC IN (
                        SELECT id_doc FROM digital_account_docs
                        WHERE natureza_transacao = 'Compra'))))""",
}

# --- credit ----------------------------------------------------------------------------

CLIENT_TYPE = """CASE flow WHEN 'fgts_flow' THEN 'FGTS' WHEN 'default_flow' THEN 'Cliente Novo'
    WHEN 'pre_approved_flow' THEN 'Pre aprovado' WHEN 'recurring_flow' THEN 'Recorrente'
    ELSE 'exchangeeGanhe' END"""


def utm(key: str) -> str:
    value = f"json_extract(utm_data, '$.{key}')"
    return f"CASE WHEN json_type({value}) NOT IN ('OBJECT', 'ARRAY') THEN {value} ->> '$' END"


LOAN_FACTS = f"""SELECT id AS contrato, borrower_id, state, lent_at, settled_at,
    {CLIENT_TYPE} AS tipo_de_cliente,
    CASE WHEN flow = 'refinancing_flow' THEN 'positivo'
         WHEN partner_id BETWEEN 3 AND 5 THEN 'credpartner' || partner_id
         WHEN flow = 'pre_approved_flow' AND ({utm("utm_source")}) IS NULL THEN 'pontos'
         WHEN partner_id <> 1 OR partner_id IS NULL OR utm_data IS NULL THEN 'positivo'
         WHEN ({utm("utm_campaign")}) = 'finanzero' THEN 'credpartner1'
         WHEN ({utm("utm_source")}) IN ('pontos', 'responsys') THEN 'credpartner2'
         ELSE 'Outros' END AS origem
    FROM loans"""

PROFILE = f"""{tax_id("document")} AS NU_CPF, split_part(name, ' ', 1) AS name, email,
    mobile_number AS celular, CAST({REF} - birthdate AS INTEGER) AS dias,
    address_city AS cidade"""

CREDIT_BASE = {
    "loan_facts": LOAN_FACTS,
    "credit_acquired": f"""SELECT {PROFILE}, 'contrato ativo' AS status_do_contrato,
            address_state AS uf, tipo_de_cliente, origem, c.chavecliente
        FROM loan_facts JOIN borrowers AS b ON borrower_id = b.id
        LEFT JOIN customers_a AS c ON {padded("document")} = {padded("NumeroDocumento")}
        WHERE state = 'lent' AND {local("lent_at")} = {back(3)}""",
    "credit_settled_base": f"""SELECT {PROFILE}, 'contrato ativo' AS status_do_contrato,
            address_state AS uf, tipo_de_cliente, origem, contrato,
            (SELECT count(late_at) FROM parcelas WHERE loan_id = contrato) AS qnt_parcelas_atrasadas
        FROM loan_facts JOIN borrowers AS b ON borrower_id = b.id
        WHERE state = 'settled' AND {local("settled_at")} = {back(3)}""",
    "credit_settled": f"""SELECT DISTINCT NU_CPF, c.chavecliente, name, email, celular, dias,
            cidade, CASE qnt_parcelas_atrasadas WHEN 0 THEN 'em_dia' ELSE 'atraso' END
            AS forma_quitacao, uf, tipo_de_cliente, origem
        FROM credit_settled_base
        LEFT JOIN customers_a AS c ON {padded("NU_CPF")} = {padded("NumeroDocumento")}""",
}


def credit_block(flag: str, base: str, test: str) -> str:
    return f"""SELECT DISTINCT NU_CPF AS cpf, chavecliente, 1 AS {flag}, 1 AS credito
        FROM {base} WHERE {test}"""


CREDIT_BLOCKS = {
    "credit_aquisicaoplus": credit_block("aquisicaoplus", "credit_acquired", "origem <> 'pontos'"),
    "credit_aquisicaopts": credit_block("aquisicaopts", "credit_acquired", "origem = 'pontos'"),
    "credit_aquisicaofgts": credit_block(
        "aquisicaofgts", "credit_acquired", "tipo_de_cliente = 'FGTS'"
    ),
    "credit_quitadosplus": credit_block("quitadosplus", "credit_settled", "origem <> 'pontos'"),
    "credit_quitadospts": credit_block("quitadospts", "credit_settled", "origem = 'pontos'"),
}

# --- consolidation ---------------------------------------------------------------------


def outer_chain(first: str, *steps: tuple[str, str]) -> str:
    """``first`` full-outer-joined with each (relation, shared columns) in turn."""
    return first + "".join(f" FULL OUTER JOIN {name} USING ({on})" for name, on in steps)


def zeros(flags: Iterable[str]) -> str:
    return ", ".join(f"coalesce({flag}, 0) AS {flag}" for flag in flags)


EXCHANGE_KEYS = "chavecliente, exchange"
CHAINS = {
    "account_chain": "SELECT * FROM "
    + outer_chain(
        "tp_contapontos",
        ("tp_pix_sent", "chavecliente, contapontos"),
        ("tp_pix_received", "chavecliente, contapontos, pix"),
        ("tp_bondcard", "chavecliente, contapontos"),
    ),
    "credit_chain": "SELECT * FROM "
    + outer_chain(
        "credit_aquisicaoplus",
        *((name, "cpf, chavecliente, credito") for name in list(CREDIT_BLOCKS)[1:]),
    ),
    "touch_chain": f"SELECT chavecliente, {padded('NumeroDocumento')} AS cpf, "
    + columns(POINTS_FLAGS)
    + " FROM ("
    + outer_chain(
        "tp_bonus",
        *((f"tp_{block}", "chavecliente, addition") for block in
          ("duplamarca", "online", "varejo", "telecom", "bancos")),
        ("tp_trip", "chavecliente"),
        *((f"tp_{block}", EXCHANGE_KEYS) for block in
          ("physicalchannel", "digitalchannel", "money")),
        ("account_chain", "chavecliente"),
    )
    + ") JOIN customers_a USING (chavecliente)",
    "full_chain": "SELECT cpf, chavecliente, "
    + zeros(FLAGS)
    + " FROM touch_chain FULL OUTER JOIN credit_chain USING (cpf, chavecliente)",
}

BIT_TEXT = " || ".join(f"CAST({flag} AS VARCHAR)" for flag in FLAGS)
FLAG_SUM = " + ".join(FLAGS)

CONSOLIDATED = {
    "flags_account_split": "SELECT chavecliente, "
    + zeros(["contapontos", "acumctadigital", "pix", "cartaobond"])
    + " FROM account_chain",
    "credit_merged": "SELECT cpf, chavecliente, " + zeros(CREDIT_FLAGS) + " FROM credit_chain",
    "flags_split": "SELECT cpf, chavecliente, " + zeros(POINTS_FLAGS) + " FROM touch_chain",
    "flags_with_credit": "SELECT * FROM full_chain",
    "one_per_person": f"""SELECT * EXCLUDE (place), {REF} AS data_atualizacao FROM (
        SELECT *, row_number() OVER (PARTITION BY cpf ORDER BY chavecliente DESC NULLS LAST,
            {FLAG_SUM} DESC, {BIT_TEXT} DESC) AS place FROM full_chain) WHERE place = 1""",
    "flags_merge": f"""SELECT cpf, max(chavecliente) AS chavecliente,
            {", ".join(f"max({flag}) AS {flag}" for flag in FLAGS)}, {REF} AS data_atualizacao
        FROM full_chain
        GROUP BY cpf, CASE WHEN cpf IS NULL THEN chavecliente END""",
    "flags_own_touchpoint": f"""SELECT cpf, max(chavecliente) AS chavecliente,
            {", ".join(f"max({flag}) AS {flag}" for flag in FLAGS)},
            max(online_week) AS online_week, {REF} AS data_atualizacao
        FROM (SELECT *, 0 AS online_week FROM full_chain
            UNION ALL BY NAME
            SELECT {padded("NumeroDocumento")} AS cpf, chavecliente, online_week,
                {", ".join(f"0 AS {flag}" for flag in FLAGS)}
            FROM ({ledger(("online_week",), f"processed BETWEEN {back(7)} AND {back(1)} AND nivel2 = 'online'")})
            JOIN customers_a USING (chavecliente))
        GROUP BY cpf, CASE WHEN cpf IS NULL THEN chavecliente END""",
}

# --- suppression -----------------------------------------------------------------------

LISTS = {
    "sup_bad_email": f"""SELECT DISTINCT chavecliente, {tax_id("CPF")} AS NU_CPF FROM contatos
        WHERE coalesce(FaixaScoreEmail, 'Ruim') IN ('Ruim', 'Médio')""",
    "sup_inactive": f"""SELECT DISTINCT chavecliente, {padded("NumeroDocumento")} AS NU_CPF
        FROM customers_a WHERE DescricaoStatusConta IS DISTINCT FROM 'Ativado'""",
    "sup_optout": f"SELECT DISTINCT chavecliente, {padded('CPF')} AS NU_CPF FROM optout",
    "sup_privacy": f"""SELECT DISTINCT {tax_id("document")} AS NU_CPF FROM borrowers
        WHERE lgpd_excluded_data""",
    "sup_fraud": f"""SELECT DISTINCT CASE
            WHEN Tipo_Perda <> 'Conta Digital' THEN {tax_id("Cod_Cliente")}
            WHEN Tipo_Perda = 'Conta Digital' THEN {padded("p.NU_CPF")} END AS NU_CPF
        FROM losses
        LEFT JOIN digital_account_type AS a
            ON Tipo_Perda = 'Conta Digital' AND CAST(a.ID_CONTA AS VARCHAR) = Cod_Cliente
        LEFT JOIN digital_account_person AS p ON p.ID_PESSOAFISICA = a.ID_PESSOAFISICA""",
    "sup_indicators": """SELECT _id, pair['column'] AS "column", pair['value'] AS value
        FROM (SELECT _id, unnest(indicators) AS pair FROM coplusites)""",
    "sup_indicator_pivot": """SELECT _id,
            max(value) FILTER ("column" = 'chavecliente') AS chavecliente,
            max(value) FILTER ("column" = 'numerocpf') AS NU_CPF
        FROM sup_indicators GROUP BY _id""",
    "sup_quarantine_expiry": f"""SELECT s.createdAt, CAST(p.chavecliente AS BIGINT)
            AS chavecliente, p.NU_CPF,
            {local("s.createdAt")} + CASE s.answered WHEN TRUE THEN 90 WHEN FALSE THEN 15 END
            AS QuarantineExpiryDate
        FROM coplusites AS s JOIN sup_indicator_pivot AS p ON p._id = s._id
        WHERE p.chavecliente IS NOT NULL""",
    "sup_quarantine": f"""SELECT chavecliente, max(NU_CPF) AS NU_CPF, QuarantineExpiryDate
        FROM sup_quarantine_expiry AS q
        WHERE QuarantineExpiryDate >= {REF} AND QuarantineExpiryDate = (
            SELECT max(QuarantineExpiryDate) FROM sup_quarantine_expiry AS r
            WHERE r.chavecliente = q.chavecliente)
        GROUP BY chavecliente, QuarantineExpiryDate""",
    "sup_employees": f"SELECT {padded('CPF')} AS NU_CPF FROM funcionarios WHERE CPF IS NOT NULL",
}
BLOCKING = (
    "sup_bad_email sup_inactive sup_optout sup_privacy sup_fraud sup_quarantine sup_employees"
).split()


def unrestricted(people: str) -> str:
    absent = " AND ".join(
        f"NOT EXISTS (SELECT 1 FROM {name} AS l WHERE l.NU_CPF = e.cpf)" for name in BLOCKING
    )
    return f"SELECT e.* FROM {people} AS e WHERE {absent}"


ON_LIST = {name: f"e.cpf IN (SELECT NU_CPF FROM {name} WHERE NU_CPF IS NOT NULL)" for name in BLOCKING}
ON_LISTS = " + ".join(f"CAST({name} AS INTEGER)" for name in BLOCKING)
REASON = """SELECT '{list}' AS list, count(*) FILTER ({name}) AS blocked,
    count(*) FILTER ({name} AND {total} = 1) AS blocked_alone FROM reason_marks"""


# --- draw and contact ------------------------------------------------------------------

HASH = (
    f"CAST('0x' || substr(md5(cpf || '|{REFERENCE_DAY}|'), 1, 12) AS BIGINT) / power(16, 12)"
)
POINTS_RATE = """CASE WHEN credito = 0 AND bonus + trip > 0 THEN 0.5
    WHEN credito = 0 THEN 0.05 WHEN aquisicaopts + quitadospts > 0 THEN 0.05 ELSE 0 END"""
CREDIT_RATE = "CASE WHEN credito = 1 AND aquisicaopts + quitadospts = 0 THEN 0.05 ELSE 0 END"


def first_name(name: str, default: str) -> str:
    return f"coalesce(nullif(upper(split_part({name}, ' ', 1)), ''), '{default}')"


def contact_points(drawn: str) -> str:
    return f"""SELECT {first_name("DescricaoNome", "CLIENTE pontos")} AS nome,
        (SELECT max(EMAIL) FROM contatos WHERE {tax_id("CPF")} = d.cpf) AS email, NumeroTelefone AS telefone,
        '{REFERENCE_DAY:%d/%m/%Y}' AS data_atualizacao, {columns(["cpf", "chavecliente"], "d.")},
        {columns(FLAGS)}
        FROM {drawn} AS d JOIN (
            SELECT *, {padded("NumeroDocumento")} AS tax_id FROM customers_a
            QUALIFY row_number() OVER (PARTITION BY tax_id
                ORDER BY DataUltimaAlteracaoCadastro DESC, chavecliente DESC) = 1
        ) AS c ON c.tax_id = d.cpf
        WHERE d.cpf IN (SELECT {tax_id("CPF")} FROM contatos)"""


def contact_credit(drawn: str) -> str:
    return f"""SELECT {first_name("name", "CLIENTE positivo")} AS nome, email,
        TRY_CAST(mobile_number AS BIGINT) AS telefone,
        '{REFERENCE_DAY:%d/%m/%Y}' AS data_atualizacao, {columns(["cpf", "chavecliente"], "d.")},
        {columns(FLAGS)}
        FROM {drawn} AS d JOIN borrowers ON {tax_id("document")} = d.cpf"""


BOTH_SURVEYS = """SELECT 'positivo' AS survey, * REPLACE (CAST(telefone AS VARCHAR) AS telefone)
    FROM {credit} UNION ALL SELECT 'pontos' AS survey, * FROM {points}"""

SURVEYED = {
    "suppress_all": unrestricted("flags_merge"),
    "reason_marks": "SELECT "
    + ", ".join(f"coalesce({test}, FALSE) AS {name}" for name, test in ON_LIST.items())
    + " FROM flags_merge AS e",
    "suppress_reasons": " UNION ALL ".join(
        REASON.format(list=name.removeprefix("sup_"), name=name, total=ON_LISTS) for name in BLOCKING
    ),
    "suppress_split": unrestricted("one_per_person"),
    "draw_credit": f"SELECT * FROM suppress_all WHERE {HASH} < {CREDIT_RATE}",
    "draw_points": f"SELECT * FROM suppress_all WHERE {HASH} < {POINTS_RATE}",
    "contact_credit": contact_credit("draw_credit"),
    "contact_points": contact_points("draw_points"),
    "eligibility_end_to_end": BOTH_SURVEYS.format(credit="contact_credit", points="contact_points"),
    "split_credit": contact_credit(f"(SELECT * FROM suppress_split WHERE {HASH} < {CREDIT_RATE})"),
    "split_points": contact_points(f"(SELECT * FROM suppress_split WHERE {HASH} < {POINTS_RATE})"),
    "eligibility_split_end_to_end": BOTH_SURVEYS.format(
        credit="split_credit", points="split_points"
    ),
}

# --- series ----------------------------------------------------------------------------

SCORE = """CAST(count(*) FILTER (Classificacao = 'PROMOTOR')
    - count(*) FILTER (Classificacao = 'DETRATOR') AS DOUBLE) / count(*) * 100"""


def weeks(source: str, key: str, run_day: str, extra: str = "") -> str:
    """Weekly rows of ``source``; ``key`` is the SQL of year and week columns."""
    return f"""SELECT {extra} monday, {key}, CAST(count(DISTINCT dataref) AS INTEGER) AS dias,
            count(*) FILTER (Classificacao = 'PROMOTOR') AS promotor,
            count(*) FILTER (Classificacao = 'NEUTRO') AS neutro,
            count(*) FILTER (Classificacao = 'DETRATOR') AS detrator,
            count(*) AS respondentes, avg(frac_sorteados) AS frac_sorteados,
            {SCORE} AS nps, DATE '{run_day}' AS data_atualizacao,
            count(*) * 7.5 / avg(frac_sorteados) * 7 / count(DISTINCT dataref)
            AS respondentes_ajustado
        FROM {source} GROUP BY ALL"""


CALENDAR = "year, isoweek"
ISO = "CAST(isoyear(monday) AS INTEGER) AS year, CAST(week(monday) AS INTEGER) AS isoweek"
NUMBERED = "SELECT row_number() OVER ({over} ORDER BY year, isoweek, monday) AS id, * FROM ({weeks})"
BY_SEGMENT = "PARTITION BY segment"
WEEK_COLUMNS = (
    "id monday year isoweek dias promotor neutro detrator respondentes frac_sorteados nps "
    "data_atualizacao respondentes_ajustado"
).split()
MEASURES = ("frac_sorteados", "nps", "respondentes_ajustado")


def rounded(relation: str) -> str:
    exact = ", ".join(f"round({name}, 6) AS {name}" for name in MEASURES)
    return f"SELECT * REPLACE ({exact}) FROM {relation}"


HISTORY_COLUMNS = (
    "id monday year isoweek dias data_atualizacao promotor neutro detrator respondentes "
    "frac_sorteados respondentes_ajustado nps forecast_value confidence_interval_lower_bound "
    "confidence_interval_upper_bound respondentes_fcst"
).split()


#: The normal quantile at 3/4, whose interval holds half.
QUARTILE = 0.6744897501960817


def future(series: str) -> str:
    """Four unobserved weeks after the last row of each segment."""
    return f"""SELECT segment, id + step AS id, CAST(monday + 7 * step AS DATE) AS monday,
            CAST(isoyear(monday + 7 * step) AS INTEGER) AS year,
            CAST(week(monday + 7 * step) AS INTEGER) AS isoweek, 7 AS dias,
            CAST(NULL AS BIGINT) AS promotor, CAST(NULL AS BIGINT) AS neutro,
            CAST(NULL AS BIGINT) AS detrator, CAST(NULL AS BIGINT) AS respondentes,
            CAST(7.5 AS DOUBLE) AS frac_sorteados, CAST(NULL AS DOUBLE) AS nps, data_atualizacao,
            CAST(NULL AS DOUBLE) AS respondentes_ajustado
        FROM (SELECT * FROM {series} AS s
              WHERE id = (SELECT max(id) FROM {series} AS m WHERE m.segment = s.segment))
        CROSS JOIN (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS step)"""


def with_series_means(extended: str) -> str:
    """The extended series with its own means standing in for the forecasts."""
    mean = "avg({0}) OVER (PARTITION BY segment)"
    return f"""SELECT *,
            CASE WHEN nps IS NULL THEN {mean.format("nps")} END AS forecast_value,
            CASE WHEN nps IS NULL THEN {mean.format("respondentes_ajustado")} END
            AS respondentes_fcst FROM {extended}"""


def month_score(weeks_with_forecast: str, day: str) -> str:
    return f"""SELECT segment, DATE '{day}' AS data_atualizacao,
            CAST(date_trunc('month', DATE '{day}') AS DATE) AS mes,
            round(sum(coalesce(nps, forecast_value)
                * coalesce(respondentes_ajustado, respondentes_fcst))
                / sum(coalesce(respondentes_ajustado, respondentes_fcst)), 6) AS nps_fcst
        FROM {weeks_with_forecast}
        WHERE date_trunc('month', monday) = date_trunc('month', DATE '{day}') GROUP BY segment"""


def real_months(day: str) -> str:
    return f"""SELECT segment, DATE '{day}' AS data_atualizacao,
            CAST(date_trunc('month', dataref) AS DATE) AS mes, round({SCORE}, 6) AS nps_real
        FROM daily_answers WHERE date_trunc('month', dataref) < date_trunc('month', DATE '{day}')
        GROUP BY ALL"""


def history(source: str, day: str) -> str:
    nulls = {c: f"CAST(NULL AS DOUBLE) AS {c}" for c in HISTORY_COLUMNS[13:]}
    dated = {"data_atualizacao": f"DATE '{day}' AS data_atualizacao"}
    return f"""SELECT segment, {", ".join({**nulls, **dated}.get(c, c) for c in HISTORY_COLUMNS)}
        FROM {source}"""


MONDAY = "CAST(dataref - CAST(isodow(dataref) - 1 AS INTEGER) AS DATE)"
SERIES = {
    "daily_answers": f"""SELECT segment, dataref, {MONDAY} AS monday,
            CAST(year(dataref) AS INTEGER) AS year, CAST(week(dataref) AS INTEGER) AS isoweek,
            Classificacao,
            CAST(CASE WHEN dataref < {RATE_CHANGE} THEN 5.0 ELSE 7.5 END AS DOUBLE)
            AS frac_sorteados
        FROM answers WHERE dataref >= {ANSWERS_SINCE}""",
    "daily_answers_text": """SELECT * REPLACE (strftime(dataref, '%Y-%m-%d') AS dataref,
            strftime(monday, '%Y-%m-%d') AS monday) FROM daily_answers""",
    "calendar_weeks": NUMBERED.format(over="", weeks=weeks("daily_answers", CALENDAR, SERIES_DAY)),
    "segment_weeks": NUMBERED.format(
        over=BY_SEGMENT, weeks=weeks("daily_answers", ISO, SERIES_DAY, "segment,")
    ),
    "extended_weeks": f"""SELECT segment, {columns(WEEK_COLUMNS)} FROM segment_weeks
        UNION ALL {future("segment_weeks")}""",
    "weekly_spine": rounded("calendar_weeks"),
    "weekly_spine_iso": rounded("segment_weeks"),
    "series_extend": rounded("extended_weeks"),
    "mean_forecast": with_series_means("extended_weeks"),
    "monthly_real": real_months(SERIES_DAY),
    "month_weights": """SELECT segment, data_atualizacao,
            CAST(date_trunc('month', monday) AS DATE) AS mes, round(nps, 6) AS nps,
            round(respondentes_ajustado, 6) AS respondentes_ajustado,
            round(forecast_value, 6) AS forecast_value,
            round(respondentes_fcst, 6) AS respondentes_fcst,
            round(coalesce(nps, forecast_value), 6) AS nps_mes,
            round(coalesce(respondentes_ajustado, respondentes_fcst), 6) AS respondentes_mes,
            round(coalesce(nps, forecast_value)
                * coalesce(respondentes_ajustado, respondentes_fcst), 6) AS npsXresp_mes
        FROM mean_forecast""",
    "monthly_forecast_weighted": month_score("mean_forecast", OBSERVED_DAY),
    "monthly_full": f"""SELECT segment, data_atualizacao, mes, nps_real, nps_fcst
        FROM monthly_real
        FULL OUTER JOIN ({month_score("mean_forecast", SERIES_DAY)})
        USING (segment, data_atualizacao, mes)""",
    "weekly_forecast_mean": f"""SELECT e.*, CASE WHEN ahead THEN round(mean, 6) END AS forecast_value,
            CASE WHEN ahead THEN round(mean - {QUARTILE} * sd, 6) END
                AS confidence_interval_lower_bound,
            CASE WHEN ahead THEN round(mean + {QUARTILE} * sd, 6) END
                AS confidence_interval_upper_bound,
            CASE WHEN ahead THEN round(volume, 6) END AS respondentes_fcst,
            CASE WHEN ahead THEN 'mean' END AS status,
            CASE WHEN ahead THEN 'mean' END AS respondents_status,
            CASE WHEN ahead THEN FALSE END AS at_search_edge
        FROM (SELECT *, nps IS NULL AS ahead FROM series_extend) AS e
        JOIN (SELECT segment, avg(nps) AS mean, stddev_pop(nps) AS sd,
                     avg(respondentes_ajustado) AS volume FROM segment_weeks GROUP BY segment)
        USING (segment)""".replace("e.*", "e.* EXCLUDE (ahead)"),
    "forecast_properties": """SELECT segment, CAST(4 AS BIGINT) AS forecast_weeks,
            count(*) AS observed_weeks, CAST(0 AS BIGINT) AS forecasts_in_the_past,
            TRUE AS inside_bounds, TRUE AS bounds_widen, TRUE AS volume_is_flat,
            TRUE AS near_the_level, TRUE AS no_wider_than_the_series,
            CAST(0 AS BIGINT) AS without_status
        FROM segment_weeks GROUP BY segment""",
    "earlier_run": history("weekly_spine_iso", EARLIER_DAY),
    "same_day_run": history("series_extend", SERIES_DAY),
    "first_run": history("weekly_spine_iso", SERIES_DAY),
    "history_typed": "SELECT * FROM same_day_run",
    "history_replace": f"""SELECT * FROM (SELECT * FROM earlier_run UNION ALL
            SELECT * FROM first_run) WHERE data_atualizacao <> DATE '{SERIES_DAY}'
        UNION ALL SELECT * FROM same_day_run""",
    "history_dashboard": """SELECT h.* FROM history_replace AS h WHERE (
            SELECT count(*) FROM history_replace AS o WHERE o.segment = h.segment
            AND o.data_atualizacao = h.data_atualizacao AND o.id > h.id) >= 2""",
}

RELATIONS = {
    **DUCK_VIEWS,
    **TOUCHPOINTS,
    **CREDIT_BASE,
    **CREDIT_BLOCKS,
    **CHAINS,
    **CONSOLIDATED,
    **LISTS,
    **SURVEYED,
    **SERIES,
}
HELPERS = {
    "loan_facts", "account_chain", "credit_chain", "touch_chain", "full_chain", "split_credit",
    "split_points", "suppress_split", "mean_forecast", "earlier_run", "same_day_run", "first_run",
    "calendar_weeks", "segment_weeks", "extended_weeks", "reason_marks",
}
# the same statements with ids left as stored
LITERAL = {
    "one_per_person_literal": "one_per_person",
    "eligibility_literal_end_to_end": "eligibility_split_end_to_end",
}
CHECKED = [name for name in RELATIONS if name not in HELPERS and name not in DUCK_VIEWS]
CHECKED += LITERAL


def _needed(name: str, seen: dict[str, None]) -> dict[str, None]:
    """The relations a statement reads, each after those it reads itself."""
    for word in re.findall(r"\b\w+\b", RELATIONS[name]):
        if word in RELATIONS and word != name and word not in seen:
            _needed(word, seen)
    seen[name] = None
    return seen


def statement(name: str) -> str:
    """The check SQL of a query, with the relations it reads as common table expressions."""
    *before, last = _needed(LITERAL.get(name, name), {})
    body = RELATIONS[last]
    if before:
        named = ",\n".join(f"{n} AS ({RELATIONS[n]})" for n in before)
        body = f"WITH {named}\n{body}"
    as_id = r"CAST(\1 AS VARCHAR)" if name in LITERAL else padded(r"\1")
    return re.sub("<<(.*?)>>", as_id, body)
