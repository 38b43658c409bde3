"""Sources and sinks: driver tables, the readings adapter, payload decoders, layer IO."""
