"""Coded domains of the service-desk schema.

FIXED VALUES: every label below must equal the published view output
character for character (Portuguese, with the per-view spelling variants).
They are listed in natural code order.
"""

from __future__ import annotations

# --- ticket status ---------------------------------------------------------
# FIXED VALUES: status labels, main ticket view spelling (codes 1..6)
STATUS_LABELS = {
    1: "Novo",
    2: "Em atendimento (atribuído)",
    3: "Em atendimento (planejado)",
    4: "Pendente",
    5: "Resolvido",
    6: "Fechado",
}
STATUS_UNKNOWN = "Desconhecido"

# FIXED VALUES: status labels, asset-ticket / problem view spelling
STATUS_LABELS_ANDAMENTO = {
    1: "Novo",
    2: "Em andamento (atribuído)",
    3: "Em andamento (planejado)",
    4: "Pendente",
    5: "Resolvido",
    6: "Fechado",
}

# FIXED VALUES: status labels, enrichment view spelling (no accents)
STATUS_LABELS_PLAIN = {
    1: "Novo",
    2: "Em andamento (atribuido)",
    3: "Em andamento (planejado)",
    4: "Pendente",
    5: "Resolvido",
    6: "Fechado",
}

# FIXED VALUES: change status labels (codes 1, 2, 5, 6; others "Outro")
CHANGE_STATUS_LABELS = {1: "Novo", 2: "Em andamento", 5: "Resolvido", 6: "Fechado"}
CHANGE_STATUS_OTHER = "Outro"

OPEN_CODES = (1, 2, 3, 4)
RESOLVED_CODES = (5, 6)
CLOSED_CODE = 6
ENTITY_OPEN_CODES = (1, 2, 3)   # the entity overview counts "open" without 4

# --- priority --------------------------------------------------------------
# FIXED VALUES: priority labels, main ticket view (codes 1..6)
PRIORITY_LABELS = {
    1: "1 - Muito Baixa",
    2: "2 - Baixa",
    3: "3 - Média",
    4: "4 - Alta",
    5: "5 - Muito Alta",
    6: "6 - Crítica",
}
PRIORITY_UNKNOWN = "Não definida"

# FIXED VALUES: priority labels, star-schema aggregates (codes 1..6)
PRIORITY_LABELS_COMPACT = {
    1: "1-Muito Baixa",
    2: "2-Baixa",
    3: "3-Média",
    4: "4-Alta",
    5: "5-Muito Alta",
    6: "6-Crítica",
}
PRIORITY_COMPACT_UNKNOWN = "N/D"

# FIXED VALUES: priority labels, CMDB / ITIL views (codes 1..6)
PRIORITY_LABELS_PLAIN = {
    1: "Muito baixa",
    2: "Baixa",
    3: "Media",
    4: "Alta",
    5: "Muito alta",
    6: "Critica",
}
PRIORITY_PLAIN_UNKNOWN = "Desconhecida"

# --- ticket type -----------------------------------------------------------
# FIXED VALUES: ticket type labels
TYPE_LABELS = {1: "Incidente", 2: "Requisição"}
TYPE_UNKNOWN = "Desconhecido"

# --- SLA -------------------------------------------------------------------
# FIXED VALUES: SLA status words
SLA_NONE = "Sem SLA"
SLA_MET = "Dentro do SLA"
SLA_BREACHED = "Violado"
SLA_BREACHED_OPEN = "Violado (aberto)"
SLA_AT_RISK = "Em risco"

# FIXED VALUES: SLA type labels (0 = time to resolve, 1 = time to own)
SLA_TYPE_LABELS = {0: "TTR (Tempo para Resolver)", 1: "TTO (Tempo para Atender)"}
# FIXED VALUES: SLA definition units -> minutes
SLA_UNIT_MINUTES = {"minute": 1, "hour": 60, "day": 1440}

# FIXED VALUES: backlog urgency words
URGENCY_NONE = "Sem SLA"
URGENCY_BREACHED = "SLA Violado"
URGENCY_CRITICAL = "SLA Crítico (< 4h)"
URGENCY_OK = "Dentro do Prazo"

# --- fallbacks -------------------------------------------------------------
# FIXED VALUES: placeholder names for missing links
NO_CATEGORY = "(sem categoria)"
NO_GROUP = "(sem grupo)"

# FIXED VALUES: category level labels
CATEGORY_ROOT = "Categoria Raiz"
CATEGORY_SUB = "Subcategoria"

# --- entities --------------------------------------------------------------
# FIXED VALUES: entity type by tree level (0, 1, deeper)
ENTITY_TYPE_LABELS = {0: "Empresa", 1: "Filial"}
ENTITY_TYPE_OTHER = "Sub-entidade"

# --- software / finance ----------------------------------------------------
# FIXED VALUES: licence state and compliance buckets, in evaluation order
LICENSE_VALID = "Vigente"
LICENSE_EXPIRED = "Expirada"
COMPLIANCE_OPEN = "Open/Free"
COMPLIANCE_OVER = "Over-licensed"
COMPLIANCE_FULL = "Fully Used"
COMPLIANCE_NEAR = "Near Limit (>=90%)"
COMPLIANCE_OK = "OK"

# FIXED VALUES: warranty status words
WARRANTY_NONE = "Sem garantia"
WARRANTY_EXPIRED = "Expirada"
WARRANTY_SOON = "Expira em <3 meses"
WARRANTY_OK = "Em garantia"

# FIXED VALUES: contract status words
CONTRACT_EXPIRED = "Expirado"
CONTRACT_SOON = "Expira em <3 meses"
CONTRACT_OK = "Vigente"

# FIXED VALUES: project state category
PROJECT_FINISHED = "Encerrado"
PROJECT_RUNNING = "Em andamento"

# FIXED VALUES: OS inventory computer class
OS_SERVER = "Servidor"
OS_WORKSTATION = "Workstation"

# FIXED VALUES: asset kinds of the entity distribution, in union order
ASSET_KIND_SERVER = "Servidor"
ASSET_KIND_WORKSTATION = "Workstation"
ASSET_KIND_NETWORK = "Rede"
ASSET_KIND_MONITOR = "Monitor"
ASSET_KIND_PRINTER = "Impressora"
ASSET_KIND_PHONE = "Telefone"
ASSET_KIND_PERIPHERAL = "Periférico"

# FIXED VALUES: CMDB item types
ITEMTYPES = ("Computer", "NetworkEquipment", "Monitor", "Printer")

# FIXED VALUES: weekday names, Monday first (DAX WEEKDAY(x, 2) numbering)
WEEKDAY_NAMES_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                    "Saturday", "Sunday")

# --- dashboard rules -------------------------------------------------------
# FIXED VALUES: KPI targets and traffic-light thresholds
SLA_TARGET_PCT = 90.0
MTTR_TARGET_HOURS = 24.0
SLA_ICON_GREEN = 0.90
SLA_ICON_YELLOW = 0.80
