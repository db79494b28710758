"""Part of hablon."""
