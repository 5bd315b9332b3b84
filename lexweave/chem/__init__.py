"""Systematic names of small organic molecules from line notation."""
