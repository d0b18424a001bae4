"""The stages of an integration run, its configuration and the driver's queries."""
