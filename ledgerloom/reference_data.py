"""Fixed values. Results depend on them, so they are stated here as plain text."""

from decimal import Decimal

# Destination labels by usage-purpose id.
USAGE_PURPOSES = {
    1: "SOTANO 5B",
    2: "SOTANO 5A",
    3: "SOTANO 4B",
    4: "SOTANO 4A",
    5: "SOTANO 3B",
    6: "SOTANO 3A",
    7: "SOTANO 2B",
    8: "SOTANO 2A",
    9: "SOTANO 1B",
    10: "SOTANO 1A",
    11: "N1",
    12: "N2",
    13: "N3",
    14: "N4",
    15: "N5",
    16: "N6",
    17: "N7",
    18: "N8",
    19: "N9",
    20: "N10",
    21: "N11",
    22: "N12",
    23: "N13",
    24: "N14",
    25: "N15",
    26: "N16",
    27: "N17",
    28: "N18",
    29: "N20",
    30: "N21",
    31: "N22",
    32: "n8",
    33: "sotano5",
    34: "NIVEL PB",
    35: "N0",
    36: "n9.",
    37: "n111",
    38: "N6",
    39: "N7, n8",
    40: "N7",
    41: "N113.",
    42: "nivel 10",
    43: "nivel 12",
    44: "n133",
    45: "NIVEL 13",
    46: "n147",
    47: "#4",
}

# The stock location whose movements are reported.
MAIN_STOCK_LOCATIONS = (8,)

# Currency ids with a known code, home currency, rates to it.
CURRENCY_BY_ID = {163: "GTQ", 2: "USD"}
HOME_CURRENCY = "GTQ"
RATES_TO_HOME = {"USD": Decimal("7.7")}

# Purchase-order states.
OPEN_PO_STATES = ("draft", "sent", "to approve", "purchase")
CLOSED_STATES = ("done", "cancel")
CASH_STATE_LABELS = {
    "draft": "Borrador (RFQ)",
    "sent": "Enviado",
    "to approve": "Por Aprobar",
    "purchase": "Orden de Compra",
}
PO_STATE_LABELS = {
    "draft": "Borrador",
    "sent": "Solicitud Enviada",
    "to approve": "Por Aprobar",
    "purchase": "Orden de Compra",
    "done": "Bloqueado",
    "cancel": "Cancelado",
}
VIEWER_STATE_LABELS = {
    "purchase": "Confirmada",
    "done": "Completada",
    "draft": "Borrador",
    "sent": "Enviada",
    "cancel": "Cancelada",
}

# Task stage names that count as completed (exact spelling).
COMPLETED_STATUSES = (
    "Hecho", "hecho", "Completo", "completo", "Done", "done",
    "Completado", "completado", "Finalizado", "finalizado",
)
FAR_FUTURE = "2099-12-31"

# Menu and form numbers of the ERP's project and task pages.
ERP_MENU_ID = "385"
PROJECT_FORM_ACTION = "139"
TASK_FORM_ACTION = "557"

# Attendance rules.
TRACKED_DEPARTMENTS = ("Obra", "Seguridad Industrial", "Operativo", "Bodega", "Administración")
WEEKLY_REGULAR_HOURS = 44
SITE_TIME_ZONE = "America/Guatemala"

# Words left out of a message search.
STOP_WORDS = (
    "de", "la", "el", "los", "las", "del", "para", "con", "que", "en", "y", "a",
    "the", "of", "and", "or", "for", "in", "to", "is", "are", "was", "were",
)

# Translation added after a search word.
TRANSLATIONS = {
    "proyecto": "project",
    "inventario": "inventory",
    "reporte": "report",
    "reunion": "meeting",
    "reunión": "meeting",
    "presupuesto": "budget",
    "cliente": "client",
    "factura": "invoice",
    "pedido": "order",
    "entrega": "delivery",
    "pago": "payment",
    "tarea": "task",
    "fecha": "date",
    "archivo": "file",
    "documento": "document",
    "urgente": "urgent",
    "planos": "plans",
    "hidráulico": "hydraulic",
    "cronograma": "schedule",
    "actualizado": "updated",
    "último": "latest",
    "cimentación": "foundation",
    "torre": "tower",
    "aprobación": "approval",
    "pendiente": "pending",
    "estado": "status",
}

# Terms added when the query contains one of the triggers.
TERM_RULES = (
    (("hidráulico", "hydraulic"), ("water", "plumbing")),
    (("torre 3",), ("tower 3", "project")),
    (("cronograma",), ("schedule", "timeline")),
)

# Parts of an address that mark a service mailbox.
SERVICE_MAILBOX_MARKS = ("noreply", "service", "system")

# Words that mark an error line in a log.
LOG_ERROR_WORDS = ("ERROR", "CRITICAL", "EXCEPTION", "TRACEBACK")

# Hours after which an output is stale.
STALE_AFTER_HOURS = 26

# Label of a blank group in the explorers.
BLANK_GROUP = "(sin dato)"
