from metricas.sources.landing import (  # noqa: F401
    cursor_page_items, graph_page_items, offset_page_items, page_object, read_landed, series_points,
)
