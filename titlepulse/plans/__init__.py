"""The jobs as lazy plans, from raw envelopes to derived tables and questions."""
