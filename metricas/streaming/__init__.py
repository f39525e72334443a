from metricas.streaming.incremental import process_pages, process_runs, run_available  # noqa: F401
