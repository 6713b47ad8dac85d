from planekit.sources.layout import hilbert_key, hilbert_order, write_points  # noqa: F401
from planekit.sources.sinks import (  # noqa: F401
    match_chunks,
    match_lines,
    pairs_as_points,
    row_text,
    write_csv,
    write_matches,
)
from planekit.sources.text import (  # noqa: F401
    parse_probes,
    parse_shapes,
    read_matches,
    read_points,
    read_probes,
    read_rects,
    read_shapes,
    take_window,
)
