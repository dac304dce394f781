"""Column contracts of the input tables, checked when a table is loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

INDICATORS = "array<struct<column: string, value: string>>"

TABLES = {
    "answers": "dataref date, Classificacao string",
    "extrato": """chavecliente bigint, chaveparceiro bigint, chavefilialparceiro bigint,
        DataProcessamentoTransacao timestamp, DataCheckOut timestamp, CodigoSubTipoPromocao int""",
    "parceiros": "chaveparceiro bigint, chavefilialparceiro bigint, nivel2 string, nivel3 string",
    "exchange": """chavecliente bigint, chavetable_exchange bigint, ChaveStatusexchange bigint,
        DataSolicitacaoexchange timestamp, FlagexchangeValida string""",
    "classe_exchange": "chavetable_exchange bigint, DescricaoOrigemexchange string",
    "status_exchange": "ChaveStatusexchange bigint, NomeStatusexchange string",
    "transactions": """status string, debitPartyTaxId string, debitPartyPersonType string,
        creditPartyTaxId string, creditPartyPersonType string, createTimestamp timestamp""",
    "customers_a": """chavecliente bigint, NumeroDocumento string, DescricaoStatusConta string,
        DescricaoNome string, NumeroTelefone string, DataUltimaAlteracaoCadastro timestamp""",
    "digital_account": "ID_DOC bigint, ID_CONTA bigint, DT_TRANSACAO_TIMESTAMP timestamp",
    "digital_account_docs": "id_doc bigint, natureza_transacao string",
    "digital_account_type": "ID_CONTA bigint, ID_PESSOAFISICA bigint",
    "digital_account_person": "ID_PESSOAFISICA bigint, NU_CPF bigint",
    "borrowers": """id bigint, document string, name string, email string, mobile_number string,
        address_city string, address_state string, birthdate date, lgpd_excluded_data boolean""",
    "loans": """id bigint, borrower_id bigint, partner_id int, flow string, state string,
        utm_data string, lent_at timestamp, settled_at timestamp""",
    "parcelas": "loan_id bigint, late_at timestamp",
    "contatos": "chavecliente bigint, CPF string, FaixaScoreEmail string, EMAIL string",
    "optout": "chavecliente bigint, CPF bigint",
    "losses": "Tipo_Perda string, Cod_Cliente string",
    "coplusites": f"_id string, createdAt timestamp, answered boolean, indicators {INDICATORS}",
    "funcionarios": "CPF bigint",
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def _family(dtype: T.DataType) -> str:
    """Types an operator treats alike."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(dtype, T.IntegralType):
        return "integer"
    return dtype.simpleString()


def check(df: DataFrame, table: str) -> DataFrame:
    """The table's own columns, or an error naming every missing or mistyped one."""
    found = {field.name: field.dataType for field in df.schema}
    wrong = []
    for field in schema_of(table):
        if field.name not in found:
            wrong.append(f"{field.name} is missing")
        elif _family(found[field.name]) != _family(field.dataType):
            wrong.append(f"{field.name} is {found[field.name].simpleString()}")
    if wrong:
        raise ValueError(f"table {table}: " + ", ".join(wrong))
    return df
