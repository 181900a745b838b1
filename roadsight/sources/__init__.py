from roadsight.sources.text import (  # noqa: F401
    parse_police_action, parse_traffic, parse_violation, read_police_actions, read_traffic,
    read_violations, stream_police_actions, stream_traffic, stream_violations,
)
from roadsight.sources.dims import (  # noqa: F401
    area_names, latest_by_key, read_monitor_limits, read_violation_list,
)
