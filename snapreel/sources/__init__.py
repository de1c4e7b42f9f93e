"""Raw documents in and out: schemas, snapshot store, raw loaders, adapters."""
