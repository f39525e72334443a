"""Jobs composed from operators, landed-page adapters, fixtures and the query registry."""
