"""Vocabularies, dictionaries and patterns that define the results.

They are plain data and the default arguments of the operators that use them; every operator
accepts a replacement.
"""

from __future__ import annotations

# --- ticket status -------------------------------------------------------------------------
STATUS_LABELS = {
    1: "Aberto",
    2: "Resolvido",
    3: "Aguardando o cliente",
    4: "Em Execução",
    5: "Fechado",
    6: "Aguardando terceiros",
    7: "Em análise",
    8: "Fechamento automático",
}
STATUS_FALLBACK = "Outros"

# Legacy generation: code 2 means open there.
STATUS_LABELS_LEGACY = {
    1: "outros",
    2: "aberto",
    3: "outros",
    4: "outros",
    5: "fechado",
    6: "outros",
    7: "outros",
    8: "outros",
}

# --- customers -----------------------------------------------------------------------------
CUSTOMER_CODES = {
    72000664348: "MILLS",
    72001771221: "SENAC",
    72000835424: "AND",
    72000747023: "SES",
}

# Whole-word fallbacks on the subject, in the order in which they are tried.
CUSTOMER_PATTERNS = (
    ("MILLS", r"\bMILLS\b"),
    ("SENAC", r"\bSENAC\b"),
    ("AND", r"\bAND\b|\bA NOSSA DROGARIA\b"),
    ("SES", r"\bSES\b|\bSECRETARIA DA SAUDE\b|\bSECRETARIA DA SAÚDE\b"),
)

CUSTOMER_NAMES_LEGACY = {
    72000664348: "Mills",
    72001771221: "Senac",
    72000835424: "A Nossa Drogaria",
    72000747023: "Secretaria da Saúde do Rio de Janeiro - SES",
}

CUSTOMER_ALIASES_LEGACY = {
    "MILLS": "MILLS",
    "SENAC": "SENAC",
    "A NOSSA DROGARIA": "AND",
    "AND": "AND",
    "SECRETARIA DA SAÚDE DO RIO DE JANEIRO": "SES",
    "SECRETARIA DA SAUDE DO RIO DE JANEIRO": "SES",
    "SECRETARIA DA SAÚDE DO RIO DE JANEIRO - SES": "SES",
    "SECRETARIA DA SAUDE DO RIO DE JANEIRO - SES": "SES",
    "SES": "SES",
}

TITLE_CUSTOMERS = ("Mills", "A Nossa Drogaria", "AND", "SES", "Senac")
TITLE_CUSTOMERS_LEGACY = ("Mills", "A Nossa Drogaria")

UNKNOWN_CUSTOMER = "NÃO IDENTIFICADO"

# --- ticket type ---------------------------------------------------------------------------
TYPE_ALIASES_LEGACY = {
    "csi": "CSI",
    "checklist": "Checklist",
    "incidente": "Incidentes",
    "incidentes": "Incidentes",
    "crise": "CRISE",
}

# --- database products: (label, keywords), first hit wins -----------------------------------
DBMS_KEYWORDS = (
    ("ORACLE", ("ORACLE",)),
    ("SQL SERVER", ("SQL SERVER", "SQLSERVER")),
    ("POSTGRESQL", ("POSTGRES", "POSTGRESQL")),
    ("MYSQL", ("MYSQL",)),
    ("MONGODB", ("MONGODB", "MONGO")),
)

# --- environments --------------------------------------------------------------------------
ENVIRONMENT_SYNONYMS = {
    "Produção": ("PRD", "PROD", "PRODUCAO", "PRODUÇÃO"),
    "Homologação": ("HML", "HOMOLOG", "HOMOLOGACAO", "HOMOLOGAÇÃO"),
    "Desenvolvimento": ("DEV", "DESENV", "DESENVOLVIMENTO"),
    "Teste": ("TESTE", "TESTES", "QA"),
    "Outro": ("OUTRO", "OUTROS"),
}

ENVIRONMENT_MACROS = ("Produção", "Não Produção")

# --- server names in free text: (literal every match contains, pattern) in priority order -----
SERVER_PATTERNS = (
    ("server", r"\bServer\s*[:\-]\s*([A-Z0-9._\-]+)"),
    ("host", r"\bHost\s*[:\-]\s*([A-Z0-9._\-]+)"),
    ("servidor", r"\bServidor\s*[:\-]\s*([A-Z0-9._\-]+)"),
    ("ncia", r"\bInst[aâ]ncia\s*[:\-]\s*([A-Z0-9._\-]+)"),
    ("database", r"\bDatabase\s*[:\-]\s*([A-Z0-9._\-]+)"),
    ("db", r"\bDB\s*[:\-]\s*([A-Z0-9._\-]+)"),
    ("-", r"^([A-Z0-9._\-]{5,})\s*-\s*"),
    ("-", r"-\s*([A-Z0-9._\-]{5,})\s*\("),
)

# --- flags and calendar ----------------------------------------------------------------------
ACTED_FLAGS = {"sim": 1, "não": 0, "nao": 0}

MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)

# --- seed members of the domain dimensions ----------------------------------------------------
SEED_MEMBERS = {
    "dim_cliente": ("SENAC", "MILLS", "AND", "SES"),
    "dim_tipo_ticket": ("Checklist", "Incidente", "CSI", "Crise", "Outro"),
    "dim_status_ticket": (
        "Aberto", "Em Execução", "Aguardando o cliente", "Resolvido", "Fechado", "Encerrado",
    ),
    "dim_status_csi": (
        "Aberto", "Em execução", "Implementado", "Aguardando resposta do cliente",
        "Encerrado - falta de contato", "Encerrado - recusado pelo cliente", "NA",
    ),
}

# --- audit expectations ---------------------------------------------------------------------
AUDIT_DOMAINS = {
    "prioridade": ("Baixa", "Média", "Alta", "Urgente"),
    "status": (
        "Aberto", "Em Execução", "Aguardando o cliente", "Resolvido", "Fechado", "Encerrado",
    ),
    "tipo_ticket": ("Checklist", "Incidente", "CSI", "Crise", "Outro"),
}

AUDIT_COLUMNS = (
    "ticket_id", "data_abertura", "data_encerramento", "servidor", "tipo_ticket", "status",
    "prioridade", "tempo_resolucao_horas", "sgdb", "ambiente_macro", "ambiente_detalhe",
    "classificacao_ticket", "titulo_csi", "link_csi", "status_csi", "auto_resolvido",
)

# Warehouse columns under audit: (table, column, declared status).
TRACEABILITY = (
    ("fato_tickets", "ticket_id", "OK"),
    ("fato_tickets", "sk_tempo_abertura", "OK"),
    ("fato_tickets", "sk_tempo_encerramento", "PARCIAL"),
    ("fato_tickets", "sk_servidor", "PARCIAL"),
    ("fato_tickets", "sk_tipo_ticket", "PARCIAL"),
    ("fato_tickets", "sk_status", "OK"),
    ("fato_tickets", "sk_prioridade", "OK"),
    ("fato_tickets", "sk_classificacao", "NAO_ATENDIDO"),
    ("fato_tickets", "tempo_resolucao_horas", "OK"),
    ("fato_servidor", "disponibilidade_percentual", "NAO_ATENDIDO"),
    ("fato_servidor", "espaco_total_gb", "NAO_ATENDIDO"),
    ("fato_servidor", "espaco_usado_gb", "NAO_ATENDIDO"),
    ("fato_servidor", "espaco_livre_gb", "NAO_ATENDIDO"),
    ("fato_servidor", "crescimento_diario_gb", "NAO_ATENDIDO"),
    ("fato_csi", "sk_csi", "PARCIAL"),
    ("fato_csi", "sk_status", "PARCIAL"),
)

# --- capacity thresholds: (upper bound, label) and (lower bound, label) -----------------------
AVAILABILITY_LABELS = ((98, "Crítico"), (99, "Atenção"))
AVAILABILITY_DEFAULT = "Normal"
GROWTH_LABELS = ((100, "Crescimento elevado"), (50, "Crescimento moderado"))
GROWTH_DEFAULT = "Crescimento normal"
