"""Reading and writing: landing files, history exports, API pages, tables."""
