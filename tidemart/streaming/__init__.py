"""The operators that need their own streaming form, and the streaming jobs."""
