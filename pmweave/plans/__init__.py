"""The four vendor x technology jobs."""
