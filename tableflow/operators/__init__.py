"""DataFrame -> DataFrame operators: records, quarantine, profiling, ingestion, ledger, delivery."""
