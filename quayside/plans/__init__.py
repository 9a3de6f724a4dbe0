"""Publishing and configuration-driven runs."""
