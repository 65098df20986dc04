"""Part of quernwork."""
