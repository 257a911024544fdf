"""Raw log lines in, typed event tables out."""
