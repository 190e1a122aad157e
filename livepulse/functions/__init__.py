"""Column-level building blocks (all built-in Spark expressions, codegen friendly)."""

from livepulse.functions.constants import *  # noqa: F401,F403
from livepulse.functions.keys import date_key, surrogate_key  # noqa: F401
from livepulse.functions.lists import (  # noqa: F401
    any_of, distinct_nested_names, field_names, parse_list_text)
from livepulse.functions.text import (  # noqa: F401
    change_text, event_label, normalise_tag, readable_ts, resolve_thumbnail, strip_envelope)
from livepulse.functions.time import (  # noqa: F401
    epoch_to_ts, parse_iso_ts, truncate_ts, uptime_seconds)
