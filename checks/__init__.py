"""Inputs, registered queries and their SQL twins for the driver's checks."""
