"""Writers: keyed upsert, ledger, manifest, routed rows."""
