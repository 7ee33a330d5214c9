"""See the package README."""
