"""Words and layouts that published rows and control tables carry.

Everything here is a FIXED VALUE: consumers filter and join on these words and
column names, so they must not change.
"""

# --- Fixed values: actions a contract may declare -------------------------
QUARANTINE = "QUARENTENA"
QUARANTINE_AND_ALERT = "QUARENTENA_E_ALERTA"
QUARANTINE_GROUP = "QUARENTENA_GRUPO"
ALERT = "ALERTA"
BLOCK = "BLOQUEIA_PUBLICACAO"

WITHDRAWING = (QUARANTINE, QUARANTINE_AND_ALERT, QUARANTINE_GROUP)
ALERTING = (ALERT, QUARANTINE_AND_ALERT)

# --- Fixed values: violation classes, allowed actions, quality dimension ---
MALFORMED = "linha_malformada"
NOT_NULL = "nulidade"
CONVERSION = "conversao"
KEY_NULL = "chave_nula"
KEY_DUPLICATE = "chave_duplicada"
DOMAIN = "dominio"
RULE = "regra"

ALLOWED_ACTIONS = {
    MALFORMED: (QUARANTINE, QUARANTINE_AND_ALERT, BLOCK),
    NOT_NULL: (QUARANTINE, QUARANTINE_AND_ALERT, ALERT, BLOCK),
    CONVERSION: (QUARANTINE, QUARANTINE_AND_ALERT, ALERT, BLOCK),
    KEY_NULL: (QUARANTINE, QUARANTINE_AND_ALERT, BLOCK),
    KEY_DUPLICATE: (QUARANTINE_GROUP, BLOCK),
    DOMAIN: (QUARANTINE, QUARANTINE_AND_ALERT, ALERT, BLOCK),
    RULE: (QUARANTINE, QUARANTINE_AND_ALERT, ALERT, BLOCK),
}

DIMENSION = {
    MALFORMED: "Conformity",
    NOT_NULL: "Completeness",
    CONVERSION: "Completeness",
    KEY_NULL: "Completeness",
    KEY_DUPLICATE: "Uniqueness",
    DOMAIN: "Consistency",
}

# --- Fixed values: where a row goes ---------------------------------------
TO_PUBLISH = "PUBLICAR"
TO_QUARANTINE = "QUARENTENA"
TO_BLOCK = "BLOQUEIO"

# --- Fixed values: logical types and date notation ------------------------
TEXT = "texto"
INTEGER = "inteiro"
LONG = "inteiro_longo"
DECIMAL = "decimal"
DATE = "data"

DATE_TOKENS = {"AAAA": "yyyy", "MM": "MM", "DD": "dd"}

# --- Fixed values: character sets (contract word -> the one Spark reads) ----
# windows-1252 is read as ISO-8859-1 and put right by sources.delimited
CHARSETS = {
    "utf-8": "UTF-8",
    "iso-8859-1": "ISO-8859-1",
    "windows-1252": "ISO-8859-1",
}

# --- Fixed values: lineage columns ----------------------------------------
PERIOD_COL = "competencia"
PART_COL = "_arquivo_origem"
RUN_COL = "_id_execucao"
LINEAGE = (PERIOD_COL, PART_COL, RUN_COL)

# --- Fixed values: contract states ----------------------------------------
DRAFT = "PROVISORIO_DOCUMENTAL"
VALIDATED = "VALIDADO_FISICO"
APPROVED = "APROVADO"
OBSOLETE = "OBSOLETO"

# --- Fixed values: run types, status and results --------------------------
ACQUISITION = "AQUISICAO"
INSPECTION = "INSPECAO"
BRONZE = "BRONZE"
SILVER = "SILVER"
APPROVAL = "APROVACAO"
DIAGNOSIS = "DIAGNOSTICO"

RUNNING = "EM_EXECUCAO"
SUCCESS = "SUCESSO"
SUCCESS_WITH_ALERT = "SUCESSO_COM_ALERTA"
BLOCKED = "BLOQUEADA"
FAILED = "FALHA"
EFFECTIVE = (SUCCESS, SUCCESS_WITH_ALERT)

ACQUIRED = "ADQUIRIDA"
EXISTING = "EXISTENTE"
COMPATIBLE = "COMPATIVEL"
INCOMPATIBLE = "INCOMPATIVEL"
RESULT_APPROVED = "APROVADA"
REFERENCE_OK = "CONFERIDA"
REFERENCE_ORPHANS = "COM_ORFAOS"
REFERENCE_MISSING = "REFERENCIA_AUSENTE"
# from the mildest to the worst
REFERENCE_SEVERITY = (REFERENCE_OK, REFERENCE_ORPHANS, REFERENCE_MISSING)

TO_CONFIRM = "A_CONFIRMAR"

# --- Fixed values: control-table layouts ----------------------------------
RUN_LOG_DDL = """
    id_execucao string, identificador string, tipo string, status string,
    ambiente string, fonte string, base string, entidade string,
    competencia string, tabela_destino string, versao_contrato int,
    estado_contrato string, hash_leitura string, hash_contrato string,
    publication_fingerprint string, id_execucao_origem string,
    versao_delta bigint, linhas_origem bigint, linhas_publicadas bigint,
    linhas_quarentena bigint, resultado string, responsavel string,
    motivo string, detalhes string, versao_motor string,
    iniciado_em timestamp, finalizado_em timestamp
"""

QUARANTINE_DDL = """
    id_quarentena string, identificador string, camada string, fonte string,
    base string, entidade string, competencia string,
    publication_fingerprint string, versao_contrato int, hash_leitura string,
    hash_contrato string, id_execucao string, chave string,
    grupo_problema string, motivos string, registro string,
    arquivo_origem string, ocorrencia int, registrado_em timestamp
"""

PARTITION_COL = "identificador"

CATALOG_DDL = {
    "catalogo_ativos": """
        ativo string, camada string, identificador string, fonte string,
        base string, entidade string, descricao string, chave string,
        versao_contrato int, estado_contrato string, hash_contrato string,
        fonte_documental string, existe boolean, eixo_informacao string,
        data_steward string, descricao_organizacional string
    """,
    "catalogo_colunas": """
        ativo string, coluna string, ordem int, tipo string, nulavel boolean,
        chave boolean, dominio string, descricao string,
        descricao_organizacional string
    """,
    "catalogo_dependencias": """
        ativo string, depende_de string, tipo string, coluna string,
        coluna_referenciada string
    """,
}

CATALOG_KEYS = {
    "catalogo_ativos": ("ativo",),
    "catalogo_colunas": ("ativo", "coluna"),
    "catalogo_dependencias": ("ativo", "depende_de", "tipo", "coluna"),
}

CATALOG_CURATED = {
    "catalogo_ativos": (
        "eixo_informacao",
        "data_steward",
        "descricao_organizacional",
    ),
    "catalogo_colunas": ("descricao_organizacional",),
    "catalogo_dependencias": (),
}

# --- Fixed values: limits of reported evidence ----------------------------
EXAMPLES = 10
EVIDENCE_CHARS = 200
ERROR_CHARS = 4000
SAMPLE_CHARS = 60
SEPARATOR_CANDIDATES = (";", ",", "|", "\t")
