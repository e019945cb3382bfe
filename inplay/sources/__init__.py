"""Readers, the stored table, and JDBC options."""
