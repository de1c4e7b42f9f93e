"""Set-based operators: replay routing, incremental enrichment, keyed replace, checks."""
