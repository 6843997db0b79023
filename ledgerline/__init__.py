"""Filing-evidence analytics as DataFrame transformations."""
