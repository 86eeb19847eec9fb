"""Part of strideway."""
