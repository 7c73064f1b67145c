"""The layered load: which tables exist, what they are built from, and running it."""
