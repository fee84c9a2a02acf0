"""Reading messages, events and results; writing lines and results."""
