"""Table plans: the reference's build order as lazy DataFrame compositions."""
