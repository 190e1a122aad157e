"""Fixed values that results must reproduce exactly (labels, formats, defaults)."""

# --- fixed values -------------------------------------------------------------
GAME_CHANGE = "GAME_CHANGE"
TITLE_CHANGE = "TITLE_CHANGE"
EVENT_TYPES = (GAME_CHANGE, TITLE_CHANGE)
UNKNOWN = "Unknown"
THUMBNAIL_PLACEHOLDER = r"\{width\}x\{height\}"  # regex for the literal "{width}x{height}"
THUMBNAIL_1080P = "1920x1080"
READABLE_TS_FORMAT = "MMMM dd, yyyy - HH:mm:ss"
QUADRANT_HIDDEN_GEM = "Hidden gem"
QUADRANT_MAINSTREAM = "Mainstream hit"
QUADRANT_OVERHYPED = "Overhyped"
QUADRANT_NICHE = "Niche"
PERIOD_SEPARATOR = "–"  # en dash, as in "2000–2004"
QUARTER_PREFIX = "Qtr "
ARROW = " → "  # "old → new"
IDLE_HOURS = 12
POLLS_PER_HOUR = 60
ENVELOPE_HEADER_BYTES = 5
