from mixprep.cli import main

main()
