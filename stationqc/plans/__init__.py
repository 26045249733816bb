"""Multi-operator plans: slots, hours, days."""
