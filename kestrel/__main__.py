from kestrel.jobs import main

main()
