"""Business operators: tables in, tables out. Every one is lazy and takes its date and its settings as parameters."""
