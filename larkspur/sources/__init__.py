"""Sources: event log, envelope codec, catalog declarations."""
