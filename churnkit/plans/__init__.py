"""The telecom preset: fixed values and the wiring of the operators."""
