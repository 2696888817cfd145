"""Fixed values and per-country settings.

Everything a deployment would change (column names, labels, source sets, owner
domain, creative name) is data in this module, so each query is written once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: state codes -------------------------------------------------
QUALIFIED_MM = (20, 63)
QUALIFIED_INMO = (20,)
STATE_DUPLICATE = 1
STATE_INCOMPLETE = 7
LATE_DISCARD = (3, 10, 16, 33, 38, 55, 56, 61, 64)
WAITING_INCOMPLETE = (7, 39)
WAITING_REVIEW = (3,)
REQUALIFIED = 20

# --- Fixed values: grains ------------------------------------------------------
# D day, W ISO week (Monday), C commercial cycle (Wednesday to Tuesday),
# M month, Q quarter, Y year. Only Y keeps its full history.
GRAINS = ("D", "W", "C", "M", "Q", "Y")
LATEST_BUCKETS = 25
TAIL_BUCKETS = {"day": 60, "week": 52, "month": 18}

# --- Fixed values: source labels ----------------------------------------------
LABELS_REVIEW = {
    3: "WEB",
    7: "Estudio Inmueble",
    20: "CRM",
    35: "Comercial",
    39: "Broker",
    46: "Propiedades",
    47: "lead_forms",
}
LABELS_HOURLY = {
    3: "WEB",
    7: "Estudio",
    20: "CRM",
    35: "Comercial",
    39: "Broker",
    46: "Propiedades",
    47: "Leadforms",
}
LABELS_ASSIGNED_CO = {
    3: "WEB",
    7: "Estudio",
    20: "CRM",
    35: "Comercial",
    37: "Leadforms",
    39: "Brokers",
    41: "Leadforms",
    42: "Leadforms",
    47: "Leadforms",
}
LABELS_ASSIGNED_MX = {
    3: "WEB",
    7: "Estudio",
    35: "Comercial",
    39: "Brokers",
    46: "Propiedades",
    47: "Leadforms",
}
LABELS_EXPLORER = {
    1: "Ventanas",
    3: "WEB",
    7: "Estudio",
    20: "CRM",
    37: "Leadform",
    39: "Broker",
    41: "Leadform",
    42: "Leadform",
    47: "Leadform",
}
LABEL_EXPLORER_OTHER = "Otro"

# Display order of the source catalogue; unknown labels follow in text order.
CATALOGUE_ORDER = ("WEB", "Leadforms", "Estudio", "CRM", "Propiedades", "Brokers", "Comercial")

# --- Fixed values: channels ----------------------------------------------------
LEAD_FORM_NAMES = ("lead_forms", "Lead Forms")
LEAD_FORM_CHANNEL = "lead_forms"

# --- Fixed values: stages of the asset funnel, with their spellings --------------
STAGE_SPELLINGS = {
    "asg": ("Primer asignacion",),
    "cit": ("Cita Agendada", "Cita Agendada (hubspot)"),
    "vis": ("Visita Efectuada", "Visita Efectuada (hubspot)"),
    "apr": ("Aprobado General", "Primer inmueble aprobado"),
    "acp": ("Acepto Oferta - Pendiente firma",),
    "cie": ("Cierre - Comprado",),
}
# Stages that the second track never reaches; reported as 0.
STAGES_NOT_ON_INMO = ("cit", "vis", "apr", "acp", "cie")

# --- Fixed values: web form ------------------------------------------------------
FORM_PREFIX = "/formulario-inmueble"
FORM_PATHS = (
    ("/formulario-inmueble/direccion", "direccion"),
    ("/formulario-inmueble/inmuebles-zona", "zona"),
    ("/formulario-inmueble/confirmar-ubicacion", "zona"),
    ("/formulario-inmueble/sugerencias", "zona"),
    ("/formulario-inmueble/datos-inmueble", "datos_inmueble"),
    ("/formulario-inmueble/contacto", "contacto"),
    ("/formulario-inmueble/caracteristicas", "caracteristicas"),
    ("/formulario-inmueble/ultimos-detalles", "ultimos_detalles"),
    ("/formulario-inmueble/felicitaciones", "felicitaciones"),
)
FORM_LAST_PATH = "/formulario-inmueble/felicitaciones"
FORM_STAGES = (
    "direccion",
    "zona",
    "datos_inmueble",
    "contacto",
    "caracteristicas",
    "ultimos_detalles",
    "felicitaciones",
)
FORM_ALL_STAGES = FORM_STAGES + ("lead_hubspot",)
FORM_SOURCES = ("web_puro", "help_to_sell", "ayuda_venta")
FORM_UNTRACKED_SOURCE = "ayuda_venta"
FORM_URL_PATTERN = "%utm_content=help_to_sell%"
FORM_REFERRER_PATTERN = "%ayudaventas-web.example%"
FORM_SUB_SOURCE = "Ayuda Venta"

# --- Fixed values: five-rule eligibility -----------------------------------------
ELIGIBLE_STATES = (
    "sin pricing incial",
    "sin pricing inicial",
    "no gestionado",
    "cierre",
    "no hay suficientes datos para comparar",
)
OWNER_STEM = "casa."
EXCLUDED_RATINGS = ("n", "nh")
FLAGS_5 = ("pf_state", "pf_priced", "pf_listing", "pf_owner", "pf_rating")
GAP_BUCKETS = ("F7-F10", "F12", "F15", "F3", "F11")
GAP_OTHER = "Otro"

# --- Fixed values: thirteen-rule eligibility --------------------------------------
FLAGS_13 = tuple(f"F{i}" for i in range(3, 16))
STATE_MASK = 240
OTHER_MASK = 7951
ALL_ON = 8191
SHARED_MAILBOX_WORDS = ("agente", "delta", "call")
BLOCKED_OWNERS = ("supplier#000000005@casa.example", "supplier#000000006@casa.example")
CONDITIONAL_OWNERS = (
    "supplier#000000007@casa.example",
    "supplier#000000009@casa.example",
    "supplier#000000011@casa.example",
)

# --- Fixed values: incomplete profile ---------------------------------------------
COMPLETENESS_ATTRS = ("garage", "bath", "rooms", "area", "age")
INFORMATIVE_ATTRS = ("lift", "lot", "address", "type")
RECOVERY_AGENTS = (
    "callcenter", "bot", "whatsapp", "duplicates", "pricing", "docking", "staff", "others",
)
PROPERTY_TYPES = ("1", "2", "3", "4", "5", "other", "none")

# --- Fixed values: target sheet ----------------------------------------------------
SHEET_SECTIONS = (
    ("Anuales", "annual"),
    ("Trimestrales", "quarterly"),
    ("Mensuales", "monthly"),
    ("Semanales", "weekly"),
    ("Ciclos", "cycles"),
    ("Diarias", "stop"),
)
SHEET_FIRST_OFFSET = 7
SHEET_BLOCK = 7
SHEET_ERRORS = ("#N/A", "-", "#REF!", "#VALUE!")
MONTH_NAMES = (
    "Enero",
    "Febrero",
    "Marzo",
    "Abril",
    "Mayo",
    "Junio",
    "Julio",
    "Agosto",
    "Septiembre",
    "Octubre",
    "Noviembre",
    "Diciembre",
)
MONTH_SHORT = ("Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic")

# --- Fixed values: thresholds --------------------------------------------------------
SIGNIFICANCE = 0.10
ACTIVE_DAYS = 30
STALE_MINUTES = 45
TOP_STATES = 10


@dataclass(frozen=True)
class CountrySpec:
    """What differs between two countries that hold the same facts."""

    code: str
    label: str
    mart_label: str
    utc_offset: int
    zone: str
    source_ids: tuple[int, ...]
    wide_source_ids: tuple[int, ...]
    first_assignment: str
    inmo_teams: tuple[str, ...]
    labels_assigned: dict[int, str]
    # acquisition channel -> source id
    spend_sources: dict[str, int]
    # channel mediums merged into the lead-form channel
    lead_form_aliases: tuple[str, ...]
    # channel prefix -> source label
    spend_prefixes: tuple[tuple[str, str], ...]
    sheet_blocks: tuple[str, ...]
    # warehouse column -> canonical column
    columns: dict[str, str] = field(default_factory=dict)


_LEAD_COLUMNS = {
    "nid": "asset_id",
    "fuente_id": "source_id",
    "fuente": "source_name",
    "fecha_creacion": "created_at",
    "campana_mercadeo": "campaign",
}

CO = CountrySpec(
    code="CO",
    label="Colombia",
    mart_label="colombia",
    utc_offset=-5,
    zone="America/Bogota",
    source_ids=(3, 7, 20, 35, 39, 47),
    wide_source_ids=(3, 7, 20, 35, 37, 39, 41, 42, 47),
    first_assignment="Primer_asigancion",
    inmo_teams=("Exclusivo inmobiliaria CO",),
    labels_assigned=LABELS_ASSIGNED_CO,
    spend_sources={"Web": 3, "Estudio": 7, "Calculadora de gastos": 7, "Lead Form": 47},
    lead_form_aliases=("lead_forms Paid", "lead_forms Direct"),
    spend_prefixes=(
        ("WEB", "WEB"),
        ("Estudio Inmueble", "Estudio Inmueble"),
        ("Lead Forms", "lead_forms"),
    ),
    sheet_blocks=(
        "TOTAL", "Perfo", "WEB", "lead_forms", "Estudio Inmueble", "CRM", "Broker", "Comercial",
    ),
    columns=_LEAD_COLUMNS | {"negocio_id": "deal_id"},
)

MX = CountrySpec(
    code="MX",
    label="México",
    mart_label="mexico",
    utc_offset=-6,
    zone="America/Mexico_City",
    source_ids=(3, 7, 35, 39, 46, 47),
    wide_source_ids=(3, 7, 35, 39, 46, 47),
    first_assignment="Primer asignacion",
    inmo_teams=(
        "Inmobiliaria 1", "Inmobiliaria 2", "Inmo ciudades MX", "Inmobliaria mx", "Inmo puebla",
    ),
    labels_assigned=LABELS_ASSIGNED_MX,
    spend_sources={"Web": 3, "Lead Form": 47},
    lead_form_aliases=("lead_forms Paid", "lead_forms Direct", "Lead Forms Paid"),
    spend_prefixes=(
        ("WEB", "WEB"),
        ("Estudio Inmueble", "Estudio Inmueble"),
        ("Lead Forms", "lead_forms"),
        ("Propiedades", "Propiedades"),
    ),
    sheet_blocks=(
        "TOTAL", "Perfo", "WEB", "lead_forms", "Estudio Inmueble", "Propiedades", "Broker",
        "Comercial",
    ),
    columns=_LEAD_COLUMNS | {"id_negocio": "deal_id"},
)

COUNTRIES = (CO, MX)
