"""End-to-end jobs composed of sources, operators, models and sinks."""
