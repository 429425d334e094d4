"""costframe package."""
