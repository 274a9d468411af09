"""Structured Streaming form of the incremental STG -> ODS load (see ``increment``)."""
