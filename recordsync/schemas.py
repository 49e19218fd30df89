"""Fixed vocabularies and schemas shared by every operator.

Values in the FIXED VALUES block must equal the source system's for the
results to agree; they are stated here once, in their natural order.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the synchronised systems)
# ---------------------------------------------------------------------------

# Ordered CRM pipeline, canonical (CRM language) names, first to last.
STAGES_CANONICAL = [
    "Descartado",
    "Novos leads",
    "Pesquisa (filtro 1)",
    "Prospecção (filtro 2)",
    "Passagem de bastão",
    "Desenvolvimento/Orçamento",
    "Ativação",
    "Retenção/Expansão",
]
# Fields of a lead that the two change sets compare, and that the field-level diff compares.
LEAD_DIFF_COLS = ["id", "name", "taxid", "address_street", "address_zipcode", "address_number", "address_complement",
                  "address_district", "city", "state", "sales_rep", "client_code", "tax_registration",
                  "financial_analysis"]
DIFF_FIELDS = ["name", "stage", "taxid", "industry", "source", "phone", "address_street", "address_zipcode",
               "address_number", "address_complement", "address_district", "city", "state", "sales_rep",
               "tax_registration", "financial_analysis"]

# The same eight stages as the ERP views name them (last three are fixed by
# the views; the first five are our translation).
STAGES_ALIAS = [
    "Discarded",
    "New leads",
    "Research (filter 1)",
    "Prospecting (filter 2)",
    "Handoff",
    "Development/Budget",
    "Activation",
    "Retention/Expansion",
]
# Stages whose leads are kept in step with the ERP.
SYNCED_STAGES = ["Development/Budget", "Activation", "Retention/Expansion"]
BUDGET_STAGE = "Development/Budget"
ACTIVATION_STAGE = "Activation"

# CRM custom-field ids.
CF_SALES_REP = "_cod.gestores"
CF_CLIENT_CODE = "_cod.cliente"
CF_TAX_REGISTRATION = "_inscricaoestadual"
CF_FINANCIAL_ANALYSIS = "_analisefinanceira"

# Registration code for tax-exempt companies, both spellings.
EXEMPT_TEXT = "ISENTO"
EXEMPT_CODE = "99"

# Defaults used when a field is absent.
DEFAULTS = {
    "phone": "5500000000",
    "financial_analysis": "Vazio.",
    "address_complement": "",
    "sales_rep": 99,
    "city": 10000,
    "state": "XX",
    "country": "US",
    "address_street": "X",
    "industry": 10,
}
#: Registration of a client that the cascade creates without one.
NEW_CLIENT_REGISTRATION = "EXEMPT"
DEFAULT_SALES_REP = 99
DEFAULT_INDUSTRY = 10

# Required CRM lead fields, in check order (nested ones as "parent.child").
LEAD_REQUIRED = ["id", "lead", "cnpj", "industry.value", "source.value", "street", "cep", "number", "district",
                 "city", "state"]
CONTACT_REQUIRED = ["id", "name", "email", "phone1", "jobTitle"]

# lead column -> (parent object path, key)
LEAD_KEYS = {
    "stage": ("$.Lead", "Stage"),
    "taxid": ("$.Lead", "CpfCnpj"),
    "industry": ("$.Lead.Industry", "value"),
    "source": ("$.Lead.Origin", "value"),
    "phone": ("$.Lead", "Phone"),
    "name": ("$.Lead", "Company"),
    "address_zipcode": ("$.Lead.Address", "ZipCode"),
    "address_complement": ("$.Lead.Address", "AddAddressInformation"),
    "city": ("$.Lead.Address", "City"),
    "state": ("$.Lead.Address", "State"),
}

# Field length limits of the CRM tables.
MAX_LEN = {"name": 40, "address_street": 50, "phone": 13, "job_title": 30}

# Budget / sale payload product.
BUDGET_PRODUCT_ID = 10001

# Value overrides of the budget / order functions (client code -> value).
BUDGET_VALUE_OVERRIDES = {1001: 10000}
ORDER_VALUE_OVERRIDES = {1002: 10000}

# Three qualification answers sent for every new lead (question id, answer id).
QUALIFICATION_QA = [
    (100001, 200001),
    (100002, 200002),
    (100003, 200003),
]
QUALIFICATION_QUESTION_TYPE = "2"
PAYLOAD_COUNTRY = "Brasil"
SALE_REP_EMAIL = "sales@example.com"
OBSERVATION_TEXT = {"N": "Contato atualizado - Sincronizar", "S": "Contato atualizado - Sincronizado"}

# Old (CRM export) -> canonical column names.
RENAME_MAP = {
    "cnpj": "taxid",
    "mercado": "industry",
    "origem": "source",
    "telefone": "phone",
    "end_rua": "address_street",
    "end_cep": "address_zipcode",
    "end_numero": "address_number",
    "end_complemento": "address_complement",
    "end_bairro": "address_district",
    "end_cidade": "city",
    "end_estado": "state",
    "representante": "sales_rep",
    "inscricao_estadual": "tax_registration",
    "analise_financeira": "financial_analysis",
    "cod_cliente": "client_code",
    "valor_orcamento": "budget_value",
    "valor_pedido": "order_value",
    "nome": "name",
    "cargo": "job_title",
    "contato_principal": "is_primary",
}

# Accented letters and their plain forms (Latin-1 supplement + Latin
# Extended-A letters seen in the data).  `ß` is kept.
ACCENTED = "ÀÁÂÃÄÅàáâãäåÈÉÊËèéêëÌÍÎÏìíîïÒÓÔÕÖòóôõöÙÚÛÜùúûüÇçÑñÝýÿ"
PLAIN = "AAAAAAaaaaaaEEEEeeeeIIIIiiiiOOOOOoooooUUUUuuuuCcNnYyy"

# ---------------------------------------------------------------------------
# Domain schemas
# ---------------------------------------------------------------------------

LEAD_COLUMNS = [
    "id", "name", "stage", "taxid", "industry", "source", "phone",
    "address_street", "address_zipcode", "address_number", "address_complement",
    "address_district", "city", "state", "sales_rep", "tax_registration",
    "client_code", "budget_value", "order_value", "financial_analysis",
]

LEADS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("taxid", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("address_street", T.StringType()),
    T.StructField("address_zipcode", T.StringType()),
    T.StructField("address_number", T.IntegerType()),
    T.StructField("address_complement", T.StringType()),
    T.StructField("address_district", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("sales_rep", T.LongType()),
    T.StructField("tax_registration", T.StringType()),
    T.StructField("client_code", T.LongType()),
    T.StructField("budget_value", T.DecimalType(18, 2)),
    T.StructField("order_value", T.DecimalType(18, 2)),
    T.StructField("financial_analysis", T.StringType()),
])

CONTACTS_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("client_code", T.StringType()),
    T.StructField("is_primary", T.BooleanType()),
])

ERROR_LOG_SCHEMA = T.StructType([
    T.StructField("log_id", T.LongType()),
    T.StructField("created_on", T.TimestampType()),
    T.StructField("created_by", T.StringType()),
    T.StructField("errorcode", T.LongType()),
    T.StructField("callstack", T.StringType()),
    T.StructField("errorstack", T.StringType()),
    T.StructField("backtrace", T.StringType()),
    T.StructField("error_info", T.StringType()),
])

MISSING_FIELD_SCHEMA = T.StructType([
    T.StructField("lead_id", T.StringType()),
    T.StructField("lead_name", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("value", T.StringType()),
])

CUSTOM_FIELD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("value", T.StringType()),
])

WEBHOOK_CONTACT = T.StructType([
    T.StructField("Id", T.LongType()),
    T.StructField("LeadId", T.LongType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Email", T.StringType()),
    T.StructField("Phone", T.StringType()),
    T.StructField("Position", T.StringType()),
])

WEBHOOK_LEAD = T.StructType([
    T.StructField("Id", T.LongType()),
    T.StructField("CpfCnpj", T.StringType()),
    T.StructField("Company", T.StringType()),
    T.StructField("Stage", T.StringType()),
    T.StructField("Phone", T.StringType()),
    T.StructField("Industry", T.StructType([T.StructField("value", T.StringType())])),
    T.StructField("Origin", T.StructType([T.StructField("value", T.StringType())])),
    T.StructField("Address", T.StructType([
        T.StructField("Address_Maps", T.StringType()),
        T.StructField("ZipCode", T.StringType()),
        T.StructField("AddAddressInformation", T.StringType()),
        T.StructField("City", T.StringType()),
        T.StructField("State", T.StringType()),
    ])),
    T.StructField("CustomFields", T.ArrayType(CUSTOM_FIELD)),
    T.StructField("Contact", T.ArrayType(WEBHOOK_CONTACT)),
])

WEBHOOK_DOC = T.StructType([
    T.StructField("Lead", WEBHOOK_LEAD),
    T.StructField("kind", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("_corrupt_record", T.StringType()),
])


class DocumentKind(NamedTuple):
    """A kind of queue document: how its files' names begin, and its schema (none: the document is only archived)."""

    prefix: str
    schema: str | None


_LEAD_DOCUMENT = (
    "Lead struct<Id:bigint, Company:string, Stage:string, CpfCnpj:string, Phone:string, Industry:struct<value:string>, "
    "Origin:struct<value:string>, Address:struct<ZipCode:string, AddAddressInformation:string, City:string, State:string>, "
    "CustomFields:array<struct<id:string, value:string>>, "
    "Contact:array<struct<Id:bigint, Name:string, Email:string, Phone:string, Position:string>>>")

#: The file names that the queue's writers give each kind.
DOCUMENT_KINDS = {
    "lead_update": DocumentKind("update_leads_in_erp_", _LEAD_DOCUMENT),
    "lead_converted": DocumentKind("converted_lead_", _LEAD_DOCUMENT),
    "lead_discarded": DocumentKind("lead_descartada_", None),
    "contact_update": DocumentKind("contato_update_erp_", "Id bigint, Name string, Email string, Phone string, Position string, "
                                                          "lead_cnpj string"),
    "timeline": DocumentKind("inserted_timeline_", "Id bigint, LeadId bigint, Text string"),
}
