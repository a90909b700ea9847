"""Where rows come from: group folders, files, tables."""
