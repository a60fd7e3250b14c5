"""Where events and ranges come from, and where tables go to."""
