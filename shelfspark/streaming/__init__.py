"""Event topics: document fan-out to ``(topic, value)`` and bounded replay."""
